"""Learners and transformers as ``pyspark.ml`` stages that can be saved and loaded.

Every estimator has its settings as params, ``fit`` leaves it unchanged and returns a model; models transform frames like the
library's own (``pred`` and, where there are probabilities, ``proba`` are appended).  A saved model is its params plus one
Parquet row with what was learnt, so whole ``Pipeline`` and ``PipelineModel`` objects can be written to shared storage and read back.
"""

from __future__ import annotations

import dataclasses
import json

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter

from vecstack.operators import boosting as B
from vecstack.operators import calibrate as C
from vecstack.operators import linear as L
from vecstack.operators import pca as P
from vecstack.operators import scale as S
from vecstack.operators import trees as T


def _numbers(x) -> list:
    return np.asarray(x).tolist()


# ---------------------------------------------------------------- what was learnt, as JSON and back
def _ensemble_out(e: T.TreeEnsemble) -> dict:
    return {"nodes": {c: [None if pd.isna(v) else v for v in e.nodes[c].tolist()] for c in e.nodes.columns},
            "params": dataclasses.asdict(e.params), "classes": [int(c) for c in e.classes]}


def _ensemble_in(s: dict) -> T.TreeEnsemble:
    nodes = pd.DataFrame(s["nodes"]).astype({"tree": "int64", "node": "int64", "is_leaf": "bool", "feature": "int64", "threshold": "float64",
                                            "pred": "int64", "n": "float64", "depth": "int64", "searched": "bool"})
    return T.TreeEnsemble(nodes, T.TreeParams(**s["params"]), s["classes"])


_CODECS = {
    "scaler": (lambda m: {"mean": _numbers(m.mean), "std": _numbers(m.std), "zero_variance": m.zero_variance},
               lambda s: S.ScalerModel(np.array(s["mean"]), np.array(s["std"]), s["zero_variance"])),
    "pca": (lambda m: {"mean": _numbers(m.mean), "components": _numbers(m.components), "eigenvalues": _numbers(m.eigenvalues),
                       "variance_ratio": m.variance_ratio, "total": m.total},
            lambda s: P.PCAModel(np.array(s["mean"]), np.array(s["components"]), np.array(s["eigenvalues"]), s["variance_ratio"], s["total"])),
    "linear": (lambda m: {"W": _numbers(m.W), "b": _numbers(m.b), "classes": [int(c) for c in m.classes]},
               lambda s: L.LinearModel(np.array(s["W"]), np.array(s["b"]), s["classes"])),
    "forest": (_ensemble_out, _ensemble_in),
    "boosted": (lambda m: {"ensemble": _ensemble_out(m.ensemble), "classes": [int(c) for c in m.classes], "lr": m.lr, "rounds_used": m.rounds_used, "n_rounds": m.n_rounds},
                lambda s: B.BoostedOvR(_ensemble_in(s["ensemble"]), s["classes"], s["lr"], s["rounds_used"], s["n_rounds"])),
    "platt": (lambda m: {"a": _numbers(m.a), "b": _numbers(m.b), "classes": [int(c) for c in m.classes]},
              lambda s: C.PlattModel(np.array(s["a"]), np.array(s["b"]), s["classes"])),
}


class _ModelWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.instance, path, spark)
        state = json.dumps(_CODECS[self.instance.kind][0](self.instance.fitted))
        spark.createDataFrame([(state,)], "state string").coalesce(1).write.parquet(f"{path.rstrip('/')}/data")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        state = self.sparkSession.read.parquet(f"{path.rstrip('/')}/data").first()["state"]
        model.fitted = _CODECS[self.cls.kind][1](json.loads(state))
        return model


class _Columns(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "column of features (array of doubles)", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "column of labels", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "column that is appended", TypeConverters.toString)

    def col(self, name: str) -> str:
        return self.getOrDefault(getattr(self, name))


class _FittedStage(Model, _Columns, MLReadable, MLWritable):
    """A fitted object as a model stage."""
    kind = ""

    def __init__(self, fitted=None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", outputCol="features")
        self.fitted = fitted

    def write(self):
        return _ModelWriter(self)

    @classmethod
    def read(cls):
        return _ModelReader(cls)


class _LearnerStage(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator whose settings are params; ``settings`` of a subclass are their names and defaults."""
    settings: dict = {}

    def __init__(self, **values):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", outputCol="features", **self.settings)
        self._set(**values)

    def with_settings(self, **values):
        """The stage with other settings (a copy)."""
        return self.copy({getattr(self, k): v for k, v in values.items()})

    def chosen(self) -> dict:
        return {k: self.getOrDefault(getattr(self, k)) for k in self.settings}

    def _handing_on(self, model):
        for c in ("featuresCol", "labelCol", "outputCol"):
            model._set(**{c: self.col(c)})
        return model


_CONVERTERS = {int: TypeConverters.toInt, float: TypeConverters.toFloat, str: TypeConverters.toString, bool: TypeConverters.toBoolean}


def _with_params(cls):
    for name, default in cls.settings.items():
        setattr(cls, name, Param(Params._dummy(), name, f"setting {name} (default {default!r})", _CONVERTERS[type(default)]))
    return cls


# ---------------------------------------------------------------- stages
class ScalerStageModel(_FittedStage):
    kind = "scaler"

    def _transform(self, df):
        return self.fitted.transform(df, self.col("featuresCol"), self.col("outputCol"))


@_with_params
class ScalerStage(_LearnerStage):
    """Population scaler."""
    settings = {"zero_variance": "eps"}

    def _fit(self, df):
        return self._handing_on(ScalerStageModel(S.fit_scaler(df, self.col("featuresCol"), **self.chosen())))


class PcaStageModel(_FittedStage):
    kind = "pca"

    def _transform(self, df):
        own = self.col("outputCol")
        out = self.fitted.transform(df, self.col("featuresCol"), "_pca_out")
        return out.drop(own).withColumnRenamed("_pca_out", own)


@_with_params
class PcaStage(_LearnerStage):
    """Principal components by variance ratio."""
    settings = {"variance_ratio": 0.95}

    def _fit(self, df):
        return self._handing_on(PcaStageModel(P.fit_pca(df, self.col("featuresCol"), **self.chosen())))


class SoftmaxStageModel(_FittedStage):
    kind = "linear"

    def _transform(self, df):
        return self.fitted.predict(df, self.col("featuresCol"))


@_with_params
class SoftmaxStage(_LearnerStage):
    """M1 / M2: softmax regression by full-batch gradient descent."""
    settings = {"lr": 0.3, "n_iter": 400, "reg": 1e-4}

    def _fit(self, df):
        return self._handing_on(SoftmaxStageModel(L.fit_softmax_gd(df, features=self.col("featuresCol"), label=self.col("labelCol"), **self.chosen())))


class ForestStageModel(_FittedStage):
    kind = "forest"

    def _transform(self, df):
        return self.fitted.predict_column(df, self.col("featuresCol"))


@_with_params
class ForestStage(_LearnerStage):
    """M7 / M8: hard-vote forest; ``max_features`` is the name of a rule."""
    settings = {"n_estimators": 60, "sample_ratio": 0.3, "min_rows": 1000, "max_depth": 8, "min_samples_split": 20, "min_samples_leaf": 5, "max_features": "sqrt",
                "n_thresholds": 16, "thresholds": "exact", "decimals": -1, "seed": 42}

    def _fit(self, df):
        c = self.chosen()
        own = {k: c.pop(k) for k in ("n_estimators", "sample_ratio", "min_rows")}
        c["decimals"] = None if c["decimals"] < 0 else c["decimals"]
        fitted = T.fit_forest(df, params=T.TreeParams(**c), label=self.col("labelCol"), features=self.col("featuresCol"), **own)
        return self._handing_on(ForestStageModel(fitted))


class BoostStageModel(_FittedStage):
    kind = "boosted"

    def _transform(self, df):
        return self.fitted.predict_proba(df, self.col("featuresCol"))


@_with_params
class BoostStage(_LearnerStage):
    """Boosted one-vs-rest trees."""
    settings = {"n_estimators": 35, "lr": 0.15, "max_depth": 4, "min_samples_split": 10, "min_samples_leaf": 5, "n_thresholds": 8, "subsample_rate": 0.6,
                "early_stop": True, "max_features": "sqrt", "seed": 42, "thresholds": "exact"}

    def _fit(self, df):
        return self._handing_on(BoostStageModel(B.fit_boosting(df, label=self.col("labelCol"), features=self.col("featuresCol"), **self.chosen())))


class PlattStageModel(_FittedStage):
    kind = "platt"

    def _transform(self, df):
        return self.fitted.transform(df, self.col("featuresCol"), self.col("outputCol"))


@_with_params
class PlattStage(_LearnerStage):
    """Per-class sigmoid calibration of a column of probabilities (``featuresCol``)."""
    settings = {"max_iter": 200, "lr": 0.05}

    def _fit(self, df):
        from vecstack.operators.evaluate import distinct_labels
        classes = distinct_labels(df, self.col("labelCol"))
        return self._handing_on(PlattStageModel(C.fit_platt(df, classes, self.col("featuresCol"), self.col("labelCol"), **self.chosen())))
