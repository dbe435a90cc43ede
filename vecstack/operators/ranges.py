"""Ranks and running sums of ordered values without a task that holds a whole key.

The rows of every key are cut into ranges of the ordered column (boundaries from a mergeable sketch,
which only decides how even the ranges are).  The sums of each range, combined before the shuffle, give
the sums before a range; rows are then sorted inside their range alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecstack.session import cut_lineage

RANGES = 512               # ranges of one key, at most
KEYS_BROADCAST = 50_000    # keys whose boundaries (RANGES numbers each) may travel to every task


def with_range(rows: DataFrame, keys: list[str], x: str, out: str = "rng", ranges: int | None = None, n_keys: int | None = None) -> DataFrame:
    """``rows`` with the number of their range: equal values share one, larger values a later one.

    ``n_keys`` is the number of different keys, if known."""
    ranges = ranges or RANGES
    if ranges < 2:
        return rows.withColumn(out, F.lit(0))
    cuts = [i / ranges for i in range(1, ranges)]
    edges = rows.groupBy(*keys).agg(F.array_distinct(F.percentile_approx(x, cuts, 4 * ranges)).alias("_edges"))
    if n_keys is not None and n_keys <= KEYS_BROADCAST:
        edges = F.broadcast(edges)
    return rows.join(edges, keys).withColumn(out, F.size(F.filter("_edges", lambda e: e < F.col(x)))).drop("_edges")


def sums_before(rows: DataFrame, keys: list[str], rng: str, values: list[str]) -> DataFrame:
    """``(keys, rng, own_v..., before_v..., all_v...)``: the sums in, before and over all ranges, one row a range."""
    own = rows.groupBy(*keys, rng).agg(*[F.sum(v).alias(f"own_{v}") for v in values])
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy(rng).rowsBetween(Window.unboundedPreceding, -1)
    return own.select("*", *[F.coalesce(F.sum(f"own_{v}").over(earlier), F.lit(0)).alias(f"before_{v}") for v in values],
                      *[F.sum(f"own_{v}").over(whole).alias(f"all_{v}") for v in values])


def values_at(rows: DataFrame, keys: list[str], x: str, w: str, fractions: list[float], n_keys: int | None = None) -> DataFrame:
    """``(keys, q array<double>)``: linear-interpolated percentiles of ``x`` repeated ``w`` times.

    Only rows of the ranges that hold a wanted rank are shuffled and sorted."""
    rows = with_range(rows.select(*keys, x, w).where(F.col(w) > 0), keys, x, n_keys=n_keys)
    at = [F.lit(f) * (F.col(f"all_{w}") - 1) for f in fractions]
    ranks = F.array_distinct(F.array(*[r.cast("bigint") for a in at for r in (F.floor(a), F.ceil(a))]))
    held = sums_before(rows, keys, "rng", [w]).withColumn("ranks", F.filter(ranks, lambda r: (r >= F.col(f"before_{w}")) & (r < F.col(f"before_{w}") + F.col(f"own_{w}"))))
    held = held.where(F.size("ranks") > 0).select(*keys, "rng", "ranks", F.col(f"before_{w}").alias("before"), F.col(f"all_{w}").alias("n"))
    if n_keys is not None and n_keys * 2 * len(fractions) <= 1_000_000:
        held = F.broadcast(held)
    inside = Window.partitionBy(*keys, "rng").orderBy(x).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = rows.join(held.select(*keys, "rng"), [*keys, "rng"], "left_semi").groupBy(*keys, "rng", x).agg(F.sum(w).alias(w))
    same = same.withColumn("upto", F.sum(w).over(inside)).join(held, [*keys, "rng"]).withColumn("upto", F.col("upto") + F.col("before"))
    got = same.select(*keys, x, "n", F.explode(F.filter("ranks", lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col(w)))).alias("rank"))
    got = got.groupBy(*keys).agg(F.first("n").alias(f"all_{w}"), F.map_from_entries(F.collect_list(F.struct("rank", x))).alias("m"))
    value = lambda r: F.element_at("m", r.cast("bigint"))
    q = [value(F.floor(a)) + (value(F.ceil(a)) - value(F.floor(a))) * (a - F.floor(a)) for a in at]
    return got.select(*keys, F.array(*q).alias("q"))


def running_sums(rows: DataFrame, keys: list[str], rng: str, x: str, values: list[str]) -> DataFrame:
    """``rows(keys, rng, x, values...)``, one row for each ``x`` of a key, with ``upto_v`` (the sum up to and with the row) and ``all_v``."""
    before = sums_before(rows, keys, rng, values).drop(*[f"own_{v}" for v in values])
    inside = Window.partitionBy(*keys, rng).orderBy(x).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.join(before, [*keys, rng]).select("*", *[(F.col(f"before_{v}") + F.sum(v).over(inside)).alias(f"upto_{v}") for v in values]) \
        .drop(*[f"before_{v}" for v in values])


def rows_at(rows: DataFrame, keys: list[str], rng: str, x: str, ranks: list[int]) -> DataFrame:
    """``(keys, rank, x)``: the value of ``x`` at the given 0-based ranks within each key (ranks beyond the end are left out).

    ``rng`` is a column that never falls as ``x`` grows; only the rows whose ``rng`` holds a rank are shuffled."""
    rows = rows.select(*keys, rng, x, F.lit(1).cast("bigint").alias("_one"))
    wanted = F.array(*[F.lit(r).cast("bigint") for r in ranks])
    held = sums_before(rows, keys, rng, ["_one"]).withColumn(
        "_ranks", F.filter(wanted, lambda r: (r >= F.col("before__one")) & (r < F.col("before__one") + F.col("own__one"))))
    held = held.where(F.size("_ranks") > 0).select(*keys, rng, "_ranks", F.col("before__one").alias("_before"))
    near = rows.join(F.broadcast(held), [*keys, rng])         # at most one row for each key and rank
    inside = Window.partitionBy(*keys, rng).orderBy(x)
    near = near.withColumn("rank", F.col("_before") + F.row_number().over(inside) - 1)
    return near.where(F.array_contains("_ranks", F.col("rank"))).select(*keys, "rank", x)


def numbered(rows: DataFrame, order: list, out: str = "number") -> DataFrame:
    """``rows`` with their 0-based place in a global order, without a window over all rows: a range sort,
    the rows counted in each of its partitions, and the counts before a partition added to the places in it."""
    placed = cut_lineage(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before, at = [], 0
    for r in placed.groupBy(part.alias("p")).count().orderBy("p").collect():      # one row a partition
        before.append((r["p"], at))
        at += r["count"]
    if not before:
        return placed.withColumn(out, F.lit(None).cast("bigint")).drop("_at")
    offset = rows.sparkSession.createDataFrame(before, "_part bigint, _before bigint")
    return placed.withColumn("_part", part).join(F.broadcast(offset), "_part").withColumn(out, F.col("_before") + place).drop("_at", "_part", "_before")
