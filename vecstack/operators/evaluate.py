"""Classification metrics as aggregations.

Every report is one pass over ``(label, pred)``: each row is exploded into a
"true" and a "predicted" event keyed by class, then grouped by class with a
map-side partial aggregation, so the shuffle carries at most
partitions × classes rows whatever the input size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_labels(df: DataFrame, label: str = "label") -> list[int]:
    """Sorted distinct labels (small: one value per class)."""
    return [int(r[0]) for r in df.select(label).distinct().orderBy(label).collect()]


def class_counts(df: DataFrame, label: str = "label", weight: str | None = None) -> DataFrame:
    """A1: ``(label, n)`` rows per class (weighted when ``weight`` is given)."""
    n = F.count("*") if weight is None else F.sum(weight)
    return df.groupBy(label).agg(n.cast("bigint").alias("n"))


def gini(counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """A2: 1 − Σ p² per group of class counts; 0 for an empty group."""
    g = counts.groupBy(*keys).agg(F.sum(n).alias("_tot"), F.sum(F.col(n) * F.col(n)).alias("_sq"))
    return g.select(*keys, F.col("_tot").alias("n"),
                    F.when(F.col("_tot") > 0, F.lit(1.0) - F.col("_sq") / (F.col("_tot") * F.col("_tot")))
                    .otherwise(F.lit(0.0)).alias("gini"))


def accuracy(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """A10: one row ``(n, accuracy)``."""
    return df.agg(F.count("*").alias("n"),
                  F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def per_class_table(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Per-class ``(cls, support, predicted, tp, precision, recall, f1)``; zero division → 0."""
    ev = df.select(F.explode(F.array(
        F.struct(F.col(label).alias("cls"), F.lit(1).alias("t"), F.lit(0).alias("p"),
                 (F.col(label) == F.col(pred)).cast("int").alias("hit")),
        F.struct(F.col(pred).alias("cls"), F.lit(0).alias("t"), F.lit(1).alias("p"), F.lit(0).alias("hit")),
    )).alias("e")).select("e.*")
    g = ev.groupBy("cls").agg(F.sum("t").cast("bigint").alias("support"),
                              F.sum("p").cast("bigint").alias("predicted"),
                              F.sum("hit").cast("bigint").alias("tp"))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    g = g.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))) \
        .otherwise(F.lit(0.0))
    return g.withColumn("f1", f1)


def classification_report(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Per-class precision / recall / f1 / support + accuracy, macro and weighted rows.

    Schema ``(row STRING, precision DOUBLE, recall DOUBLE, f1 DOUBLE, support BIGINT)``;
    the accuracy row carries the accuracy in ``f1`` and null precision / recall.
    """
    per = per_class_table(df, label, pred)          # read twice: the exchange is reused
    classes = per.select(F.col("cls").cast("string").alias("row"), "precision", "recall", "f1", "support")
    tot = per.agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.count("*").alias("k"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"))
    n = F.col("n")
    safe = F.when(n > 0, n).otherwise(F.lit(None))
    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("row"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        n.cast("bigint").alias("support"))

    none = F.lit(None)
    summary = tot.select(F.explode(F.array(
        row("accuracy", none, none, F.coalesce(F.col("tp") / safe, F.lit(0.0))),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", F.coalesce(F.col("wp") / safe, F.lit(0.0)),
            F.coalesce(F.col("wr") / safe, F.lit(0.0)), F.coalesce(F.col("wf") / safe, F.lit(0.0))),
    )).alias("s")).select("s.*")
    return classes.unionByName(summary)


def weighted_f1(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """One row ``(weighted_f1)`` — support-weighted mean of per-class F1."""
    per = per_class_table(df, label, pred)
    return per.agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred",
                     classes: list[int] | None = None) -> DataFrame:
    """Long form ``(label, pred, n)`` of non-zero cells, or wide with ``classes``."""
    if classes is None:
        return df.groupBy(label, pred).agg(F.count("*").alias("n"))
    return (df.groupBy(label).pivot(pred, [int(c) for c in classes]).count().na.fill(0))
