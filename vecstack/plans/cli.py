"""Command-line entry points mirroring the reference's three runs, as Spark jobs.

  python -m vecstack.plans.cli build  --train T.csv --val V.csv --cache DIR [--side 28]
  python -m vecstack.plans.cli train  --cache DIR --train T.csv --val V.csv   (stale check)
  python -m vecstack.plans.cli hybrid --train T.csv --val V.csv [--side 28]

Inputs are labelled CSVs (header, label first, then side² pixel columns; extra
columns ignored).  Paths are arguments; the cache lives wherever ``--cache``
points (a shared folder on a cluster).
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from dataclasses import replace

from pyspark.sql import functions as F

from vecstack.operators import evaluate as ev
from vecstack.operators.image import Directional, Hog, Zonal
from vecstack.plans import flows as FL
from vecstack.session import get_spark
from vecstack.sources import files as io
from vecstack.sources.tables import valid_rows


def _config(side: int) -> FL.FeatureConfig:
    cell = max(1, side // 4)                       # 4 × 4 HOG cells (7-pixel cells on 28 × 28)
    return FL.FeatureConfig(side=side, hog=Hog(cell=cell, bins=8, signed=False, border="constant", name="hog"),
                            directional=Directional(ratios=True, name="dir"), zonal=Zonal((4, 4), "zon"))


#: Model settings of the two runs.
PHASE3, HYBRID = FL.Phase3Config(), FL.HybridConfig()


def load_split_csvs(spark, train_csv: str, val_csv: str, side: int):
    """Both CSVs as one labelled frame with a ``split`` column and unique ``row_id``s; rows with a
    malformed cell or a missing label are rejected."""
    tr = io.read_labeled_csv(spark, train_csv, n_features=side * side)
    va = io.read_labeled_csv(spark, val_csv, n_features=side * side)
    tr = tr.withColumn("row_id", F.col("row_id") * 2).withColumn("split", F.lit("train"))
    va = va.withColumn("row_id", F.col("row_id") * 2 + 1).withColumn("split", F.lit("val"))
    return tr.unionByName(va).where(valid_rows(dim=side * side))


def _report(pv, t0: float, label: str) -> dict:
    acc = ev.accuracy(pv).first()["accuracy"]
    wf1 = ev.weighted_f1(pv).first()["weighted_f1"]
    rep = [r.asDict() for r in ev.classification_report(pv).collect()]
    out = {"run": label, "accuracy": acc, "weighted_f1": wf1, "seconds": round(time.time() - t0, 2),
           "report": rep}
    print(json.dumps(out, default=float))
    return out


def cmd_build(a) -> dict:
    spark = get_spark()
    t0 = time.time()
    df = load_split_csvs(spark, a.train, a.val, a.side)
    table, models = FL.build_feature_table(df, _config(a.side), F.col("split") == "train")
    FL.write_feature_cache(spark, table, a.cache, _config(a.side), {"train": a.train, "val": a.val},
                           time.time() - t0)
    out = {"run": "build", "pca_components": models["pca"].k, "seconds": round(time.time() - t0, 2)}
    print(json.dumps(out))
    return out


def cmd_train(a) -> dict:
    spark = get_spark()
    t0 = time.time()
    tr, va, _ = FL.read_feature_cache(spark, a.cache, {"train": a.train, "val": a.val})
    pv, _ = FL.oof_calibrated_stack(tr, va, replace(PHASE3, calibrate_on=a.calibrate_on))
    return _report(pv, t0, "train")


def cmd_hybrid(a) -> dict:
    spark = get_spark()
    t0 = time.time()
    df = load_split_csvs(spark, a.train, a.val, a.side)
    table, _ = FL.build_feature_table(df, FL.hybrid_features(a.side, max(1, a.side // 4)), F.col("split") == "train")
    tr, va = table.where("split = 'train'"), table.where("split = 'val'")
    pv, _ = FL.hybrid_stack_eval(tr, va, HYBRID)
    return _report(pv, t0, "hybrid")


def main(argv=None):
    ap = argparse.ArgumentParser(prog="vecstack")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="features → feature cache + manifest")
    b.add_argument("--train", required=True)
    b.add_argument("--val", required=True)
    b.add_argument("--cache", required=True)
    b.add_argument("--side", type=int, default=28)
    t = sub.add_parser("train", help="feature cache → OOF stack → Platt → temperature → report")
    t.add_argument("--cache", required=True)
    t.add_argument("--train", required=True)
    t.add_argument("--val", required=True)
    t.add_argument("--calibrate-on", dest="calibrate_on", default="train", choices=["train", "oof"])
    h = sub.add_parser("hybrid", help="CSV → features → library-model stack → isotonic → specialists")
    h.add_argument("--train", required=True)
    h.add_argument("--val", required=True)
    h.add_argument("--side", type=int, default=28)
    a = ap.parse_args(argv)
    return {"build": cmd_build, "train": cmd_train, "hybrid": cmd_hybrid}[a.cmd](a)


if __name__ == "__main__":
    sys.exit(0 if main() else 1)
