"""Boosted one-vs-rest trees (M10, M11) and the library-model paths.

Identity used for M10: the per-class tree target is ``(Y − P)[:, k] > 0`` and
every P lies in [0, 1) (softmax over ``lr · votes`` divides by Σ + 1e-12, start
value 1/K), so for K ≥ 2 the target is exactly ``1{y = c_k}`` in every round.
Rounds therefore do not depend on each other except through the early stop
``mean|Y − P| < 0.05``: all rounds × classes are grown together as one
level-wise ensemble (tree id = round·K + k), and the stop round is found
afterwards from a running sum of votes per (row, class) over rounds.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from vecstack.functions.arrays import NORM_EPS, argmax_class, softmax
from vecstack.operators import whole_trees as WT
from vecstack.operators.trees import TreeEnsemble, TreeParams, grow, row_chunks
from vecstack.session import ensure_checkpoint_dir

EARLY_STOP_MAR = 0.05
ML_MAX_DEPTH = 30          # limit of the ML forest
GBT_MARGIN_SCALE = 2.0     # a binary GBT margin is half the log-odds: p = 1 / (1 + exp(-2 margin))


@dataclass
class BoostedOvR:
    ensemble: TreeEnsemble
    classes: list
    lr: float
    rounds_used: int
    n_rounds: int

    def used_trees(self) -> list[int]:
        K = len(self.classes)
        return [t for t in self.ensemble.tree_ids if t // K < self.rounds_used]

    def predict_proba(self, df: DataFrame, features: str = "features", key: str = "row_id",
                      proba: str = "proba", pred: str = "pred") -> DataFrame:
        """Class scores lr · Σ votes of the used rounds, softmax (÷ Σ + 1e-12), first-max class.

        Narrow: a batch of rows walks all trees at once, and tree t votes for class t mod K."""
        K, lr, classes = len(self.classes), self.lr, np.asarray(self.classes, np.int64)
        used = self.used_trees()
        shared = df.sparkSession.sparkContext.broadcast((self.ensemble.tables(used), np.array(used, np.int64) % max(K, 1)))
        schema = StructType([*df.schema.fields, StructField(proba, ArrayType(DoubleType(), False)), StructField(pred, IntegerType())])

        def run(parts):
            tables, of = shared.value
            for pdf in parts:
                p = [np.zeros((0, K))]
                for x in row_chunks(pdf[features], tables.n_trees):
                    s = np.zeros((len(x), K))
                    if tables.n_trees:
                        won = tables.votes(x) > 0
                        s = lr * np.stack([won[:, of == k].sum(axis=1) for k in range(K)], axis=1)
                    e = np.exp(s - s.max(axis=1, keepdims=True))
                    p.append(e / (e.sum(axis=1, keepdims=True) + NORM_EPS))
                p = np.concatenate(p)
                yield pdf.assign(**{proba: list(p), pred: classes[p.argmax(axis=1)].astype(np.int32) if len(p) else np.zeros(0, np.int32)})

        return df.mapInPandas(run, schema)


def fit_boosting(df: DataFrame, n_estimators: int = 35, lr: float = 0.15, max_depth: int = 4,
                 min_samples_split: int = 10, min_samples_leaf: int = 5, n_thresholds: int = 8,
                 subsample_rate: float = 0.6, early_stop: bool = True, max_features="sqrt", seed: int = 42,
                 decimals: int | None = None, thresholds: str = "exact", label: str = "label",
                 features: str = "features", key: str = "row_id") -> BoostedOvR:
    """Every (round, class) tree grown in one level-wise job over one row per data row
    (tree ``round·K + k``: weight = membership in the round's exact subsample, target =
    ``1{y = c_k}``), with percentiles per node in tasks that grow whole trees while the columns fit a worker
    (``exact_trees.py``); the early-stop round is chosen afterwards."""
    from vecstack.operators.evaluate import distinct_labels
    from vecstack.operators.sampling import subsample_membership
    classes = distinct_labels(df, label)
    K = len(classes)
    d = len(df.select(features).first()[0])
    n = df.count()
    base = df.select(key, label, features)
    mem = subsample_membership(base, subsample_rate, n_estimators, seed=seed, key=key, n=n)   # per round
    w = F.flatten(F.transform(mem, lambda x: F.array_repeat(x, K)))                         # per tree
    # a class whose subsample holds one target value gets no tree that round (bounded: rounds × classes)
    m = int(subsample_rate * n)
    counts = (base.select(F.col(label).alias("_l"), F.posexplode(mem).alias("round", "in"))
                  .where(F.col("in") == 1).groupBy("round", "_l").count().collect())
    per = {(int(r["round"]), int(r["_l"])): int(r["count"]) for r in counts}
    active = [r * K + k for r in range(n_estimators) for k, c in enumerate(classes)
              if 0 < per.get((r, int(c)), 0) < m]
    cls = F.array(*[F.lit(int(c)) for c in classes])

    def target(lab, t):
        return (lab == F.element_at(cls, (t % K + 1).cast("int"))).cast("long")

    params = TreeParams(max_depth=max_depth, min_samples_split=min_samples_split,
                        min_samples_leaf=min_samples_leaf, max_features=max_features,
                        n_thresholds=n_thresholds, decimals=decimals, seed=seed, thresholds=thresholds)
    if thresholds == "hist":
        from vecstack.operators.histogram import fit_hist
        ens = fit_hist(base, n_estimators * K, params, d, classes, mem, n_estimators, K, one_vs_rest=True, active=active,
                       label=label, features=features, key=key)
    else:
        ens = None
        if thresholds == "exact" and n_thresholds > 0 and active:
            from vecstack.operators.exact_trees import grow_one_vs_rest
            ens = grow_one_vs_rest(base, n, d, classes, mem, active, params, label, features, key)
        if ens is None:
            ens = grow(base, n_estimators * K, params, d, [0, 1], weights=w, target=target, active=active,
                       label=label, features=features, key=key)
    model = BoostedOvR(ens, classes, lr, n_estimators, n_estimators)
    if early_stop and len(ens.nodes):
        model.rounds_used = stop_round(model, df, label, features, key)
    return model


def stop_round(model: BoostedOvR, df: DataFrame, label: str = "label", features: str = "features",
               key: str = "row_id") -> int:
    """First round m whose pre-round probabilities P_m satisfy mean|Y − P_m| < 0.05 (else all)."""
    K, R, lr = len(model.classes), model.n_rounds, model.lr
    uniform = np.mean(np.abs(np.eye(K)[0] - 1.0 / K))
    if uniform < EARLY_STOP_MAR:
        return 0
    # Scores are lr·votes with at most m votes per class before round m, so
    # p_true ≤ e^{lr·m} / (e^{lr·m} + K − 1) and mean|Y − P_m| ≥ (2/K)(K − 1) / (e^{lr·m} + K − 1).
    # If that bound stays above the threshold for every checked round, no stop is possible.
    if K > 1 and (2.0 / K) * (K - 1) / (np.exp(lr * (R - 1)) + K - 1) >= EARLY_STOP_MAR + 1e-9:
        return R
    return stop_round_from_votes(model, df, label, features, key)


def stop_round_from_votes(model: BoostedOvR, df: DataFrame, label: str = "label", features: str = "features",
                          key: str = "row_id") -> int:
    """The stop round from running vote sums over all training rows.

    Narrow: a batch of rows walks all trees; each partition scores the votes per round with
    NumPy (cumulative lr·votes → softmax → mean|Y − P|) and emits R partial sums; one
    ``groupBy(round)`` finishes.  Nothing per (row, round, class) is shuffled."""
    K, R, lr = len(model.classes), model.n_rounds, model.lr
    cls = np.asarray(model.classes)
    trees = model.ensemble.tree_ids
    shared = df.sparkSession.sparkContext.broadcast((model.ensemble.tables(trees), np.array(trees, np.int64)))

    def partial(batches):
        tables, ids = shared.value
        tot, n = np.zeros(R), 0
        for b in batches:
            lab = b[label].to_numpy()
            for x in row_chunks(b[features], R * K):
                V = np.zeros((len(x), R * K))
                V[:, ids] = tables.votes(x) == 1
                S = lr * np.cumsum(V.reshape(len(x), R, K), axis=1)          # scores after round r
                E = np.exp(S - S.max(axis=2, keepdims=True))
                P = E / (E.sum(axis=2, keepdims=True) + NORM_EPS)
                Y = (lab[:len(x), None] == cls[None, :]).astype(np.float64)
                lab = lab[len(x):]
                tot += np.abs(Y[:, None, :] - P).mean(axis=2).sum(axis=0)
                n += len(x)
        if n:
            yield pd.DataFrame({"round": np.arange(R), "s": tot, "n": np.full(R, n)})

    v = df.select(label, features)
    parts = v.mapInPandas(partial, "round long, s double, n long")
    mar = parts.groupBy("round").agg((F.sum("s") / F.sum("n")).alias("mar")).orderBy("round").collect()
    for r in mar:                                  # P after round r is P_{r+1}
        if r["mar"] < EARLY_STOP_MAR:
            return int(r["round"]) + 1
    return R


# ---- library-model paths (Spark ML) -----------------------------------------
WHOLE_CELLS = 600_000      # rows x trees beyond which a forest's trees grow whole in tasks, if their rows fit there
FOREST_CELLS = 600_000   # rows x trees that one ML forest takes; a larger one is grown in slices
SLICE_CELLS = 250_000      # rows x trees of a slice (a tree at least)
SLICES_AT_ONCE = 3
_ON_DRIVER = threading.Lock()      # Spark ML keeps all nodes of a forest there: one fit at a time


def fit_rf_proba(df: DataFrame, num_trees: int = 250, max_depth: int = 30, min_leaf: int = 1, seed: int = 42,
                 features: str = "features", label: str = "label", subsampling_rate: float = 1.0, whole: bool | None = None):
    """M9: the library's random forest (averaged probabilities, unlike the hard-vote M7/M8).

    Spark ML passes over all rows and all trees for each group of nodes, and the nodes grow with rows x trees.  So trees beyond
    ``WHOLE_CELLS`` (or any, if ``whole``) grow whole in tasks (``whole_trees.py``) while the binned rows fit a worker; the model is
    then a ``WholeForest``.  Else it is a list of Spark ML models: one, or for a large forest slices of trees, each with a seed of its own."""
    if max_depth > ML_MAX_DEPTH:
        raise ValueError(f"the forest grows to depth {ML_MAX_DEPTH} at most, got {max_depth}")
    if whole is not False:
        n, d = df.agg(F.count("*"), F.max(F.size(features))).first()
        if (whole or n * num_trees > WHOLE_CELLS) and WT.fits(n, d or 0):
            return WT.fit_forest(df, n, num_trees, max_depth, min_leaf, seed, subsampling_rate, features, label)
    with _ON_DRIVER:
        return _fit_ml_forest(df, num_trees, max_depth, min_leaf, seed, features, label, subsampling_rate)


def _fit_ml_forest(df: DataFrame, num_trees: int, max_depth: int, min_leaf: int, seed: int, features: str, label: str, subsampling_rate: float) -> list:
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    from vecstack.operators.stacking import run_parallel
    ensure_checkpoint_dir(df.sparkSession)           # the rows' nodes are kept from level to level, not walked to from the root each time
    data = df.select(array_to_vector(features).alias("v"), F.col(label).cast("double").alias("y")).persist(StorageLevel.MEMORY_AND_DISK)
    n = data.count()
    each = num_trees if n * num_trees <= FOREST_CELLS else max(1, SLICE_CELLS // n)
    sizes = [min(each, num_trees - i) for i in range(0, num_trees, each)]

    def fit(i: int):
        return RandomForestClassifier(featuresCol="v", labelCol="y", numTrees=sizes[i], maxDepth=max_depth, minInstancesPerNode=min_leaf,
                                      featureSubsetStrategy="sqrt", seed=seed + i, subsamplingRate=subsampling_rate, cacheNodeIds=True).fit(data)

    try:
        fitted = run_parallel({i: (lambda i=i: fit(i)) for i in range(len(sizes))}, SLICES_AT_ONCE)
    finally:
        data.unpersist()
    return [fitted[i] for i in range(len(sizes))]


def rf_predict_proba(models, df: DataFrame, classes, features: str = "features") -> DataFrame:
    """Probability array in ``classes`` order (label values are used as indices by Spark ML): the mean over all trees."""
    if isinstance(models, WT.WholeForest):
        return models.predict_proba(df, classes, features)
    from pyspark.ml.functions import array_to_vector, vector_to_array
    out = df.withColumn("v", array_to_vector(features))
    for i, model in enumerate(models):
        out = model.setRawPredictionCol(f"_r{i}").setProbabilityCol(f"_q{i}").setPredictionCol("").transform(out).drop(f"_r{i}")
    trees = [m.getNumTrees for m in models]
    parts = [vector_to_array(f"_q{i}") for i in range(len(models))]
    mean = lambda c: parts[0][c] if len(parts) == 1 else sum((p[c] * float(t) for p, t in zip(parts, trees)), F.lit(0.0)) / float(sum(trees))
    return out.withColumn("proba", F.array(*[F.coalesce(mean(int(c)), F.lit(0.0)) for c in classes])) \
              .withColumn("pred", F.element_at(F.array(*[F.lit(int(c)) for c in classes]),
                                               F.array_position("proba", F.array_max("proba")).cast("int"))) \
              .drop("v", *[f"_q{i}" for i in range(len(models))])


@dataclass
class GBTOvR:
    models: list
    classes: list

    def predict_proba(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Softmax over the K one-vs-rest log-odds."""
        from pyspark.ml.functions import array_to_vector, vector_to_array
        out = df.withColumn("_v", array_to_vector(features))
        for k, m in enumerate(self.models):
            out = m.setFeaturesCol("_v").setRawPredictionCol(f"_r{k}").setProbabilityCol(f"_pp{k}") \
                   .setPredictionCol(f"_pr{k}").transform(out)
            out = out.withColumn(f"_m{k}", vector_to_array(f"_r{k}")[1]).drop(f"_r{k}", f"_pp{k}", f"_pr{k}")
        K = len(self.classes)
        out = out.withColumn("_s", F.array(*[GBT_MARGIN_SCALE * F.col(f"_m{k}") for k in range(K)]))
        out = softmax(out, "_s", "proba", eps=None)
        out = out.withColumn("pred", argmax_class("proba", self.classes))
        return out.drop("_v", "_s", *[f"_m{k}" for k in range(K)])

    predict = predict_proba


def fit_gbt_ovr(df: DataFrame, max_iter: int = 250, step_size: float = 0.05, max_depth: int = 4,
                subsampling_rate: float = 0.9, feature_subset: str = "0.8", seed: int = 42,
                features: str = "features", label: str = "label", whole: bool = False):
    """One binary Spark ML ``GBTClassifier`` per class (it is binary-only); with ``whole`` a task boosts all rounds of
    a class by the same rules (``whole_trees.py``), if ``feature_subset`` is a share and the binned rows fit a worker."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    from vecstack.operators.evaluate import distinct_labels
    if whole and max_depth <= WT.HEAP_DEPTH:
        n, d = df.agg(F.count("*"), F.max(F.size(features))).first()
        if WT.fits(n, d or 0):
            return WT.fit_gbt(df, max_iter, step_size, max_depth, subsampling_rate, float(feature_subset), seed, features, label)
    classes = distinct_labels(df, label)
    base = df.select(array_to_vector(features).alias("v"), F.col(label).alias("_l")) \
             .persist(StorageLevel.MEMORY_AND_DISK)
    from vecstack.operators.stacking import run_parallel

    def fit_one(c):
        data = base.withColumn("y", (F.col("_l") == int(c)).cast("double"))
        return GBTClassifier(featuresCol="v", labelCol="y", maxIter=max_iter, stepSize=step_size,
                             maxDepth=max_depth, subsamplingRate=subsampling_rate,
                             featureSubsetStrategy=feature_subset, seed=seed).fit(data)

    fitted = run_parallel({i: (lambda c=c: fit_one(c)) for i, c in enumerate(classes)})   # independent
    models = [fitted[i] for i in range(len(classes))]
    base.unpersist()
    return GBTOvR(models, classes)
