"""Registry of the named queries and their DuckDB oracles, plus shared helpers.

A query is a callable ``(spark, sf_dir) -> DataFrame``; its oracle is an
independent SQL formulation (unnest / self-join / window) of the same result
over the driver's pre-registered views.  Result conventions shared by both
sides: integers are BIGINT, doubles are rounded (6 dp unless stated), arrays
are emitted in long form ``(key..., dim, value)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- Spark side
def rnd(c, d: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, d)


def big(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("bigint")


def explode_long(df: DataFrame, arr, keep=("row_id",), dim: str = "dim", value: str = "value",
                 decimals: int | None = 6) -> DataFrame:
    """``(keep..., dim BIGINT, value DOUBLE)`` from an array column, values rounded."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    out = df.select(*keep, F.posexplode(arr).alias("_d", "_v"))
    v = F.col("_v") if decimals is None else rnd("_v", decimals)
    return out.select(*keep, big("_d").alias(dim), v.alias(value))


# ---------------------------------------------------------------- SQL side
def r(x: str, d: int = 6) -> str:
    """Rounded DOUBLE with negative zero folded to zero."""
    return f"(round(({x})::DOUBLE, {d}) + 0.0::DOUBLE)"


EMB = "SELECT vec_id::BIGINT AS row_id, label::INTEGER AS label, CAST(embedding AS DOUBLE[]) AS f FROM embeddings"
EMB_TRAIN = f"SELECT * FROM ({EMB}) WHERE row_id % 5 <> 0"
EMB_VAL = f"SELECT * FROM ({EMB}) WHERE row_id % 5 = 0"


def long_sql(src: str, lst: str = "f", keep: str = "row_id, label") -> str:
    """Rows ``(keep, dim, v)`` of a list expression (0-based dim)."""
    return f"SELECT {keep}, unnest(range(len({lst}))) AS dim, unnest({lst}) AS v FROM ({src})"


LINEITEM_LABEL = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END"
