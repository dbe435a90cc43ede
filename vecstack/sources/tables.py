"""Labelled-vector frames over the driver tables.

The engine's data model is ``(row_id BIGINT, label INT, features ARRAY<DOUBLE>)``
with an explicit ``row_id`` key (never partition order).  Rows with a null
label, a null/NaN entry or a wrong vector length are rejected at load; the
reject count is available as a separate query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecstack.functions.arrays import as_double_array

VALIDATION_MOD = 5   # split = 'val' when row_id % 5 = 0 (FIXTURES), else 'train'

# Fixed label coding of lineitem.l_returnflag (sorted flag values).
RETURNFLAG_CODES = {"A": 0, "N": 1, "R": 2}
LINEITEM_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def valid_rows(features: str = "features", dim: int | None = None, label: str = "label"):
    cond = F.col(features).isNotNull() & F.col(label).isNotNull()
    cond = cond & ~F.exists(F.col(features), lambda x: x.isNull() | F.isnan(x))
    if dim is not None:
        cond = cond & (F.size(features) == F.lit(dim))
    return cond


def embeddings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("bigint").alias("row_id"),
        F.col("label").cast("int").alias("label"),
        as_double_array("embedding").alias("features"))


def labelled_vectors(spark: SparkSession, sf_dir: str, dim: int | None = 64) -> DataFrame:
    """``embeddings`` as the labelled frame, invalid rows removed."""
    return embeddings_raw(spark, sf_dir).where(valid_rows(dim=dim))


def rejected_rows(df: DataFrame, dim: int | None = None) -> DataFrame:
    """Rows a load would reject (null / NaN / wrong length)."""
    return df.where(~F.coalesce(valid_rows(dim=dim), F.lit(False)))


def with_split(df: DataFrame, key: str = "row_id", mod: int = VALIDATION_MOD) -> DataFrame:
    return df.withColumn("split", F.when(F.col(key) % mod == 0, F.lit("val")).otherwise(F.lit("train")))


def train_val(df: DataFrame, key: str = "row_id", mod: int = VALIDATION_MOD) -> tuple[DataFrame, DataFrame]:
    """Validation = ``key % mod = 0``; train = the rest (every row is used)."""
    is_val = F.col(key) % mod == 0
    return df.where(~is_val), df.where(is_val)


def _returnflag_code():
    code = F.create_map(*[x for k, v in RETURNFLAG_CODES.items() for x in (F.lit(k), F.lit(v))])
    return code[F.col("l_returnflag")].cast("int")


def lineitem_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels of ``lineitem`` alone (one column is read)."""
    return read_table(spark, sf_dir, "lineitem").select(_returnflag_code().alias("label"))


def lineitem_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a 3-class labelled frame over its four DOUBLE measures.

    lineitem has no unique key ((l_orderkey, l_linenumber) repeats in the
    driver tables), so this frame carries no ``row_id``: it feeds only the
    aggregate operators (scaler, covariance, split search, class counts).
    """
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        _returnflag_code().alias("label"),
        F.array(*[F.col(c).cast("double") for c in LINEITEM_FEATURES]).alias("features"),
    ).where(valid_rows(dim=len(LINEITEM_FEATURES)))
