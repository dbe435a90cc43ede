"""Shared frame helpers of the pipeline operators.

Inputs are read by name (``doc_id``, ``text``, ...) and every other column is left alone, so
extra columns with any name are harmless.  Large intermediate tables are written as Parquet below
the folder in ``spark.checkpoint.dir`` and deleted when the session's JVM ends; small ones use the
reliable ``checkpoint()``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecstack.session import cut_lineage, ensure_checkpoint_dir, ship_package

__all__ = ["batches_of", "components", "cut_lineage", "fresh", "materialise", "own_columns", "read", "ship_package", "texts", "with_membership",
           "without_ids", "workspace"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """``(doc_id BIGINT, text STRING, extra...)``; a null text is the empty text."""
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"),
                       F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
                       *[docs[c] for c in extra])


def workspace(spark: SparkSession) -> str:
    """A folder for tables of this application below the shared checkpoint folder."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vecstack-llm-{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return base


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back."""
    path = f"{workspace(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """While inside, Python workers get batches of at most ``rows`` rows; for steps that are run there and then."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


MEMBER_BITS = 30     # log2 of the largest bitmap of ``with_membership`` (128 MiB)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until no column of ``df`` is called like them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df`` by name, whatever the names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def with_membership(df: DataFrame, column: str, ids: DataFrame, name: str, out: str = "__listed") -> DataFrame:
    """``df`` (without a column ``out``) with a boolean ``out`` that is false only where ``column`` is not in ``ids[name]``.

    The ids are hashed into a bitmap of at least eight bits each (2^30 bits at most, so the
    broadcast is bounded); values that pass by chance are sorted out by the join that follows.  It keeps
    the rows of a wide table that a join would drop anyway from being shuffled."""
    p, k, m, _ = fresh(df, "__p", "__k", "__m", out)
    bits = 1 << max(15, min(MEMBER_BITS, (16 * ids.count()).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c.cast("bigint")), F.lit(bits)) + 1
    maps = (ids.select(place(F.col(name)).alias(p)).groupBy(F.bitmap_bucket_number(p).alias(k))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(p)).alias(m)))
    at = F.bitmap_bit_position(p)
    byte = F.conv(F.hex(F.substr(F.col(m), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    listed = F.pmod(F.floor(byte / F.pow(F.lit(2.0), at % 8)), F.lit(2)) == 1
    marked = df.withColumn(p, place(df[column])).withColumn(k, F.bitmap_bucket_number(p))
    return marked.join(F.broadcast(cut_lineage(maps)), k, "left").select(*own_columns(df), F.coalesce(listed, F.lit(False)).alias(out))


def without_ids(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is not in ``gone[name]`` (rows without an id stay).

    Only rows that the bitmap of ``gone`` lets pass are shuffled for the join."""
    listed, out = fresh(docs, "__listed", "__gone")
    gone = cut_lineage(gone.select(F.col(name).cast("bigint").alias(out)).distinct())
    marked = with_membership(docs, "doc_id", gone, out, listed)
    apart = F.col(listed) & F.col("doc_id").isNotNull()
    rest = marked.where(apart).join(gone, F.col("doc_id").cast("bigint") == F.col(out), "left_anti")
    return marked.where(~apart).union(rest).select(*own_columns(docs))


# ------------------------------------------------------------------ connected components
def _contract(parts: Iterator):
    """Union-find inside one partition: any edge list becomes stars around the smallest ids."""
    import pandas as pd
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for pdf in parts:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    nodes = [x for x in parent if root(x) != x]
    for i in range(0, len(nodes), 100_000):
        block = nodes[i:i + 100_000]
        yield pd.DataFrame({"a": block, "b": [root(x) for x in block]}, dtype="int64")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a BIGINT, b BIGINT)`` as ``(node, component)``.

    ``component`` is the smallest node reachable; nodes without an edge are not listed.  Each round
    is one large-star and one small-star step (O(log n) rounds, also for long chains), after a
    union-find inside the partitions.  Empty input gives an empty table.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = cut_lineage(e.mapInPandas(_contract, "a bigint, b bigint").distinct())
    seen = None
    for _ in range(max_rounds):
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(low, "a").where("b > a and b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))))
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        e = cut_lineage(small)
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
