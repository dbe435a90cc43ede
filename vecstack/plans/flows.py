"""End-to-end flows: feature table build (F15), the OOF-stacked calibrated
classifier (M21) and the hybrid library-model evaluation (M22).

Every fitted object is fitted on the train split only and applied to every
row (validation is only ever transformed).  Frames that several fits read
are written to the reliable checkpoint folder once, so each fit reads a short
lineage and a lost executor recomputes from that table, not from the source.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecstack.functions.arrays import argmax_class, l2_normalize, temperature_scale
from vecstack.operators import calibrate as C
from vecstack.operators import estimators as E
from vecstack.operators import evaluate as ev
from vecstack.operators import pca as P
from vecstack.operators import scale as SC
from vecstack.operators import specialists as SP
from vecstack.operators import trees as T
from vecstack.operators.image import Directional, Hog, Zonal, image_features
from vecstack.operators.stacking import fit_stacking
from vecstack.session import cut_lineage


@dataclass
class FeatureConfig:
    side: int = 28
    pca_var: float = 0.95
    hog: Hog = field(default_factory=lambda: Hog(cell=7, bins=8, signed=False, border="constant", name="hog"))
    directional: Directional = field(default_factory=lambda: Directional(ratios=True, name="dir"))
    zonal: Zonal = field(default_factory=lambda: Zonal(grid=(4, 4), name="zon"))
    zero_variance: str = "eps"

    def manifest_params(self) -> dict:
        return {"pca_var": self.pca_var, "hog": {"cell_size": self.hog.cell, "bins": self.hog.bins},
                "directional": {"dims": 6 if self.directional.ratios else 4},
                "zonal": {"grid": list(self.zonal.grid)}, "dtype": "float32"}


def hybrid_features(side: int = 28, cell: int = 7) -> FeatureConfig:
    """Features of the hybrid run: signed HOG with reflected borders, the four directional
    energies, zonal sums, and scalers that leave constant features at zero."""
    return FeatureConfig(side=side, hog=Hog(cell=cell, bins=8, signed=True, border="reflect", name="hog"),
                         directional=Directional(ratios=False, name="dir"), zero_variance="zero")


def build_feature_table(df: DataFrame, cfg: FeatureConfig, is_train) -> tuple[DataFrame, dict]:
    """pixel scaler → PCA(var) ‖ HOG, directional, zonal → per-family scalers →
    concat [pca, hog, dir, zon] → final scaler → L2-normalised copy.

    ``df``: ``(row_id, label, features, ...)``; ``is_train``: Column selecting fit rows.
    Returns the frame with ``features`` (final) and ``features_norm`` plus the fitted models."""
    models = {}
    fam = image_features(df, [cfg.hog, cfg.directional, cfg.zonal], side=cfg.side)
    fam = cut_lineage(fam.withColumn("_train", is_train))          # read by five fits below
    train = fam.where("_train")
    models["pixels"] = SC.fit_scaler(train.select("features"), "features", cfg.zero_variance)
    fam = models["pixels"].transform(fam, "features", "_px")
    models["pca"] = P.fit_pca(fam.where("_train"), "_px", cfg.pca_var)
    fam = models["pca"].transform(fam, "_px", "pca").drop("_px")
    for g in (cfg.hog.name, cfg.directional.name, cfg.zonal.name):
        models[g] = SC.fit_scaler(train.select(g), g, cfg.zero_variance)
        fam = models[g].transform(fam, g)
    fam = fam.withColumn("_cat", F.concat("pca", cfg.hog.name, cfg.directional.name, cfg.zonal.name))
    fam = cut_lineage(fam.drop(cfg.hog.name, cfg.directional.name, cfg.zonal.name, "pca"))
    models["final"] = SC.fit_scaler(fam.where("_train").select("_cat"), "_cat", cfg.zero_variance)
    out = models["final"].transform(fam, "_cat", "features").drop("_cat", "_train")
    return l2_normalize(out, "features", "features_norm"), models


def write_feature_cache(spark, table: DataFrame, path: str, cfg: FeatureConfig, sources: dict,
                        build_seconds: float) -> None:
    """S3 + S5: the feature table (float32, partitioned by ``split``) and its manifest
    (source fingerprints, parameters, build time) under ``path``."""
    from vecstack.sources import files as io
    io.write_feature_table(table.drop("features_norm"), f"{path.rstrip('/')}/features")
    io.write_manifest(io.manifest_frame(spark, sources, cfg.manifest_params(), build_seconds),
                      f"{path.rstrip('/')}/manifest")


def read_feature_cache(spark, path: str, sources: dict | None = None):
    """S4 (+ S7 when ``sources`` is given): ``(train, val, manifest)``; a stale cache raises."""
    from vecstack.sources import files as io
    manifest = io.read_manifest(spark, f"{path.rstrip('/')}/manifest")
    if sources is not None:
        stale = io.stale_check(spark, manifest, sources).where("stale").count()
        if stale:
            raise RuntimeError(f"feature cache at {path} is stale for {stale} source(s); rebuild it")
    cols = ("row_id", "label", "features", "features_norm")
    base = f"{path.rstrip('/')}/features"
    return (io.read_feature_table(spark, base, "train", cols), io.read_feature_table(spark, base, "val", cols),
            manifest)


# ---------------------------------------------------------------- M21
# The numbers below and in HybridConfig are the reference's settings (fixed values).
@dataclass
class Phase3Config:
    rf_trees: int = 25
    rf_depth: int = 8
    rf_ratio: float = 0.35
    rf_thresholds: int = 20
    knn_k: int = 5
    lr_rate: float = 0.35
    lr_iter: int = 400
    lr_solver: str = "gd"
    meta_rounds: int = 25
    meta_lr: float = 0.25
    meta_depth: int = 5
    meta_thresholds: int = 10
    meta_subsample: float = 0.6
    cv: int = 2
    platt_iter: int = 200
    platt_lr: float = 0.05
    temperature: float = 1.15
    thresholds: str = "hist"         # split candidates of forest and meta trees: 'hist' once per feature, 'exact' per node
    calibrate_on: str = "train"      # 'train': in-sample stack probabilities (faithful); 'oof': out-of-fold
    seed: int = 42


def oof_calibrated_stack(train: DataFrame, val: DataFrame, cfg: Phase3Config):
    """stack(rf, knn, lr | boosted meta, cv, passthrough) → Platt fitted on the
    stack's train probabilities (in-sample as the reference does, or out-of-fold with
    ``calibrate_on='oof'``) → temperature → argmax.  Returns
    ``(predictions (row_id, label, pred, proba), report)``."""
    rf = E.ForestLearner(cfg.rf_trees, cfg.rf_ratio,
                         T.TreeParams(max_depth=cfg.rf_depth, n_thresholds=cfg.rf_thresholds, seed=cfg.seed, thresholds=cfg.thresholds))
    bases = [("rf", rf), ("knn", E.KNNLearner(cfg.knn_k)),
             ("lr", E.SoftmaxLearner(cfg.lr_rate, cfg.lr_iter, 1e-4, cfg.lr_solver))]
    meta = E.BoostLearner(cfg.meta_rounds, cfg.meta_lr, cfg.meta_depth, n_thresholds=cfg.meta_thresholds,
                          subsample_rate=cfg.meta_subsample, seed=cfg.seed, thresholds=cfg.thresholds)
    stack, _ = fit_stacking(train, bases, meta, cv=cfg.cv, passthrough=True, seed=cfg.seed)
    if cfg.calibrate_on == "oof":
        # calibration rows predicted by stacks that never saw them: cv stacks on the other folds
        from vecstack.operators.sampling import kfold_assign
        from vecstack.operators.stacking import run_parallel
        folded = cut_lineage(kfold_assign(train, cfg.cv, seed=cfg.seed + 1))
        stacks = run_parallel({f: (lambda f=f: fit_stacking(folded.where(F.col("fold") != f).drop("fold"), bases, meta,
                                                             cv=cfg.cv, passthrough=True, seed=cfg.seed)[0])
                               for f in range(cfg.cv)}, max_workers=cfg.cv)
        parts = [stacks[f].predict_proba(folded.where(F.col("fold") == f).drop("fold")) for f in range(cfg.cv)]
        p_cal = parts[0]
        for q in parts[1:]:
            p_cal = p_cal.unionByName(q)
        p_train = cut_lineage(p_cal.select("row_id", "label", "proba"))
    else:
        p_train = cut_lineage(stack.predict_proba(train).select("row_id", "label", "proba"))
    cal = C.fit_platt(p_train, stack.classes, "proba", "label", cfg.platt_iter, cfg.platt_lr)
    pv = cal.transform(stack.predict_proba(val), "proba")
    pv = temperature_scale(pv, "proba", "proba", cfg.temperature)
    pv = pv.withColumn("pred", argmax_class("proba", stack.classes)).select("row_id", "label", "pred", "proba")
    pv = cut_lineage(pv)
    return pv, ev.classification_report(pv)


# ---------------------------------------------------------------- M22
@dataclass
class HybridConfig:
    rf_trees: int = 250
    knn_k: int = 5
    lr_iter: int = 250
    gbt_iter: int = 250
    gbt_step: float = 0.05
    gbt_depth: int = 4
    stack_cv: int = 5
    calib_cv: int = 3
    spec_iter: int = 300
    seed: int = 42


def hybrid_stack_eval(train: DataFrame, val: DataFrame, cfg: HybridConfig):
    """Library-model stack in probability mode (random forest, k-NN, LR | one-vs-rest
    GBT meta) → cross-validated isotonic calibration of the whole stack → pair
    specialists → override rules → argmax / report on validation."""
    bases = [("rf", E.RFProbaLearner(cfg.rf_trees, seed=cfg.seed, model_on_driver=False, whole=True)), ("knn", E.KNNProbaLearner(cfg.knn_k)),
             ("lr", E.SoftmaxLearner(n_iter=cfg.lr_iter, reg=None, solver="lbfgs"))]
    meta = E.GBTLearner(cfg.gbt_iter, cfg.gbt_step, cfg.gbt_depth, seed=cfg.seed, whole=True)
    classes = ev.distinct_labels(train)

    def fit_fn(d):
        return fit_stacking(d, bases, meta, cv=cfg.stack_cv, passthrough=True, seed=cfg.seed,
                            stack_method="proba", folds="stratified")[0]

    def predict_fn(m, d):
        return m.predict_proba(d)

    cal = C.fit_isotonic_cv(train, classes, fit_fn, predict_fn, cv=cfg.calib_cv, seed=cfg.seed)
    specs = SP.fit_specialists(train, max_iter=cfg.spec_iter)
    pv = cal.predict(val.select("row_id", "label", "features"))
    pv = pv.withColumn("pred0", argmax_class("proba", classes))
    pv = SP.score_specialists(pv, specs)
    pv = SP.apply_overrides(pv, SP.PAIR_RULES, proba="proba", pred="pred0", out="pred", classes=classes)
    pv = cut_lineage(pv.select("row_id", "label", "pred0", "pred", "proba"))
    return pv, ev.classification_report(pv)
