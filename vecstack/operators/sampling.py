"""Folds, bootstrap weights, subsamples and feature subsets.

Every draw is the portable MD5 hash of (seed, purpose, keys), so it does not
depend on partitioning, retries or executor count.  Exact sizes come from cut-offs:
a histogram of the hash (combined before the shuffle) tells which hash range holds
the last row of a fold or a sample, only the keys in that range are ranked, and
every row then finds its side by comparing its own hash — rows are never moved.
Where each row's own rank is wanted (:func:`hash_rank`), hash-range buckets give
offsets and a bounded bucket is ranked locally.
"""

from __future__ import annotations

import math
import numbers

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecstack.functions.hashing import HASH_RANGE, portable_hash
from vecstack.operators.ranges import rows_at

BUCKET_ROWS = 1_000_000         # target rows per rank bucket
BROADCAST_OFFSET_ROWS = 2_000_000


def hash_rank(df: DataFrame, h: Column | str, tie: str = "row_id", groups: list[str] | None = None,
              out: str = "rank", bucket_rows: int = BUCKET_ROWS, n: int | None = None) -> DataFrame:
    """0-based rank of each row in ``(h, tie)`` order within ``groups``, exact and distributed."""
    groups = list(groups or [])
    h = F.col(h) if isinstance(h, str) else h
    df = df.withColumn("_h", h)
    n = df.count() if n is None else n
    b = max(1, math.ceil(n / bucket_rows))
    df = df.withColumn("_b", F.floor(F.col("_h") * F.lit(b) / F.lit(HASH_RANGE)).cast("long"))
    counts = df.groupBy(*groups, "_b").agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*groups, "_b", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    if offs.count() <= BROADCAST_OFFSET_ROWS:          # size checked before broadcasting
        offs = F.broadcast(offs)
    lw = Window.partitionBy(*groups, "_b").orderBy("_h", tie)
    ranked = df.join(offs, [*groups, "_b"]).withColumn(out, F.col("_off") + F.row_number().over(lw) - 1)
    return ranked.drop("_h", "_b", "_off")


RANGE_BITS = 16                 # upper bits of a hash that name its range


def rank_cutoffs(keyed: DataFrame, ranks: list[int], groups: list[str] | None = None) -> dict:
    """``{group: {rank: (hash, key)}}``: who stands at the given 0-based ranks of ``keyed(groups, h, key)`` in ``(h, key)`` order."""
    groups = list(groups or [])
    ranks = sorted({r for r in ranks if r >= 0})
    if not ranks:
        return {}
    rows = keyed.select(*groups, F.shiftright("h", 32 - RANGE_BITS).alias("_rng"), F.struct("h", "key").alias("at")).withColumn("_g", F.lit(0))
    out: dict = {}
    for r in rows_at(rows, [*groups, "_g"], "_rng", "at", ranks).collect():              # one row for each group and rank
        out.setdefault(tuple(r[g] for g in groups), {})[int(r["rank"])] = (int(r["at"]["h"]), r["at"]["key"])
    return out


def _chunk_ends(n: int, cv: int) -> list[int]:
    """Last ranks of all but the last of ``cv`` near-equal chunks of ``n`` rows, the longer ones first."""
    q, rem = divmod(n, cv)
    return [f * q + min(f, rem) - 1 for f in range(1, cv)]


def _beyond(h: Column, key: Column, ends: list) -> Column:
    """How many of the ``(hash, key)`` ends (None: before the first row) lie before a row."""
    at = [F.lit(1) if e is None else ((h > e[0]) | ((h == e[0]) & (key > e[1]))).cast("int") for e in ends]
    return sum(at, F.lit(0)).cast("int")


def kfold_assign(df: DataFrame, cv: int, seed: int = 42, exact: bool = True, key: str = "row_id",
                 out: str = "fold") -> DataFrame:
    """Shuffled, unstratified k-fold.  ``exact``: chunks of the hash order whose sizes differ by one
    row at most, found by their cut-offs; otherwise ``pmod(hash, cv)`` (sizes only approximately equal)."""
    h = portable_hash(F.lit(seed), F.lit("fold"), F.col(key))
    if not exact:
        return df.withColumn(out, F.pmod(h, F.lit(cv)).cast("int"))
    ends = _chunk_ends(df.count(), cv)
    found = rank_cutoffs(df.select(h.alias("h"), F.col(key).alias("key")), ends).get((), {})
    return df.withColumn(out, _beyond(h, F.col(key), [found.get(r) for r in ends]))


def stratified_kfold(df: DataFrame, cv: int, seed: int = 42, label: str = "label", key: str = "row_id",
                     out: str = "fold", deal: str = "turns") -> DataFrame:
    """R2: folds with near-equal numbers of rows of every class.

    ``deal='turns'``: within each class, rows in hash order go to the folds in turn (every row is ranked);
    ``'chunks'``: within each class, near-equal chunks of the hash order, found by their cut-offs (rows are not moved)."""
    h = portable_hash(F.lit(seed), F.lit("strat"), F.col(key))
    if deal == "turns":
        ranked = hash_rank(df, h, tie=key, groups=[label], out="_r")
        return ranked.withColumn(out, (F.col("_r") % cv).cast("int")).drop("_r")
    if deal != "chunks":
        raise ValueError(f"deal must be 'turns' or 'chunks', got {deal!r}")
    sizes = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}              # one row a class
    ends = {c: _chunk_ends(n, cv) for c, n in sizes.items()}
    found = rank_cutoffs(df.select(F.col(label).alias("_c"), h.alias("h"), F.col(key).alias("key")),
                         [r for e in ends.values() for r in e], ["_c"])
    fold = F.lit(None).cast("int")
    for c, e in ends.items():
        mine = found.get((c,), {})
        fold = F.when(F.col(label).eqNullSafe(F.lit(c)), _beyond(h, F.col(key), [mine.get(r) for r in e])).otherwise(fold)
    return df.withColumn(out, fold)


def fold_train_rows(folded: DataFrame, cv: int, fold: str = "fold") -> DataFrame:
    """For every fold f, its training rows = all rows minus fold f (``train_fold`` column)."""
    return (folded.withColumn("train_fold", F.explode(F.sequence(F.lit(0), F.lit(cv - 1))))
                  .where(F.col(fold) != F.col("train_fold")))


def poisson_cdf(lam: float, tol: float = 1e-15) -> list[float]:
    """Cumulative Poisson(λ) probabilities c_0, c_1, … until 1 − tol."""
    out, p, c, k = [], math.exp(-lam), 0.0, 0
    while True:
        c += p
        out.append(c)
        k += 1
        p *= lam / k
        if c >= 1 - tol or k > 10 * lam + 50:
            return out


def poisson_draw(u: Column, lam: float) -> Column:
    """Inverse-CDF Poisson draw from a uniform column: #{k : CDF(k) ≤ u}."""
    terms = [F.when(u >= F.lit(c), F.lit(1)).otherwise(F.lit(0)) for c in poisson_cdf(lam)]
    return sum(terms[1:], terms[0])


def bootstrap_rate(n: int, ratio: float, min_rows: int = 1000) -> float:
    """Expected draws per row: m / n with m = max(min_rows, int(ratio · n))."""
    return max(min_rows, int(ratio * n)) / max(n, 1)


def bootstrap_weights(df: DataFrame, n_trees: int, ratio: float, seed: int = 42, min_rows: int = 1000,
                      n: int | None = None, key: str = "row_id", keep_zero: bool = False) -> DataFrame:
    """Per (tree, row) multiplicity ~ Poisson(m/n) from a hash — no copies.
    Total draws per tree ≈ m (Poisson), not exactly m."""
    n = df.count() if n is None else n
    lam = bootstrap_rate(n, ratio, min_rows)
    t = df.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
    u = portable_hash(F.lit(seed), F.lit("boot"), F.col("tree"), F.col(key)) / F.lit(HASH_RANGE)
    t = t.withColumn("weight", poisson_draw(u, lam))
    return t if keep_zero else t.where(F.col("weight") > 0)


def bootstrap_weight_array(n_trees: int, lam: float, seed: int = 42, key: str = "row_id") -> Column:
    """R3 as one ``array<int>`` per row: multiplicity of the row in every tree (same draws as
    :func:`bootstrap_weights`), so a forest never copies rows per tree."""
    def draw(t):
        u = portable_hash(F.lit(seed), F.lit("boot"), t, F.col(key)) / F.lit(HASH_RANGE)
        return poisson_draw(u, lam)
    return F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), draw)


def subsample_cutoffs(df: DataFrame, frac: float, rounds: int, seed: int = 42, key: str = "row_id",
                      n: int | None = None) -> list:
    """Per round the last member ``(hash, key)`` of the exact int(frac·n) subsample (None: empty)."""
    n = df.count() if n is None else n
    m = int(frac * n)
    if m <= 0:
        return [None] * rounds
    t = df.select(F.col(key).alias("key"), F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round"))
    t = t.withColumn("h", portable_hash(F.lit(seed), F.lit("sub"), F.col("round"), F.col("key")))
    got = rank_cutoffs(t, [m - 1], ["round"])
    return [got.get((r,), {}).get(m - 1) for r in range(rounds)]


def subsample_membership(df: DataFrame, frac: float, rounds: int, seed: int = 42, key: str = "row_id",
                         n: int | None = None, per: int = 1) -> Column:
    """R4 as one ``array<int>`` per row: 1 where the row is in round ``t // per``'s exact
    subsample (same rows as :func:`subsample`), for ``t`` in ``0 … rounds·per − 1``."""
    cuts = subsample_cutoffs(df, frac, rounds, seed, key, n)
    ch = F.array(*[F.lit(c[0] if c else -1).cast("long") for c in cuts])
    ck = F.array(*[F.lit(c[1] if c else -1).cast("long") for c in cuts])

    def member(t):
        r = (t / per).cast("int") if per > 1 else t
        h = portable_hash(F.lit(seed), F.lit("sub"), r, F.col(key))
        hc, kc = F.element_at(ch, r + 1), F.element_at(ck, r + 1)
        inside = (h < hc) | ((h == hc) & (F.col(key).cast("long") <= kc))
        return F.when((hc >= 0) & inside, F.lit(1)).otherwise(F.lit(0))
    return F.transform(F.sequence(F.lit(0), F.lit(rounds * per - 1)), member)


def subsample(df: DataFrame, frac: float, rounds: int, seed: int = 42, exact: bool = True,
              key: str = "row_id") -> DataFrame:
    """Per round, int(frac · n) rows without replacement (``exact``) or each row
    with probability ``frac``.  Output has a ``round`` column."""
    t = df.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    h = portable_hash(F.lit(seed), F.lit("sub"), F.col("round"), F.col(key))
    if not exact:
        return t.where(h / F.lit(HASH_RANGE) < F.lit(frac))
    member = subsample_membership(df, frac, rounds, seed, key)
    return df.withColumn("round", F.explode(F.filter(F.sequence(F.lit(0), F.lit(rounds - 1)), lambda r: F.element_at(member, r + 1) == 1)))


#: Named rules for the number of features that a node of ``d`` features looks at.
FEATURE_RULES = {"sqrt": math.isqrt, "all": lambda d: d}


def n_features(max_features, d: int) -> int:
    """Features a node looks at: a named rule (``None`` and booleans mean 'all'), a share of ``d``
    (fraction) or a count (whole number), kept within 1..d."""
    rule = "all" if max_features is None or isinstance(max_features, bool) else max_features
    if isinstance(rule, str):
        if rule not in FEATURE_RULES:
            raise ValueError(f"max_features must be one of {sorted(FEATURE_RULES)}, a count or a share; got {rule!r}")
        wanted = FEATURE_RULES[rule](d)
    elif isinstance(rule, numbers.Real):
        wanted = rule if isinstance(rule, numbers.Integral) else math.floor(rule * d)
    else:
        raise ValueError(f"max_features: {rule!r}")
    return int(min(d, max(1, wanted)))


def feature_subset(nodes: DataFrame, d: int, max_features="sqrt", seed: int = 42,
                   keys=("tree", "node")) -> DataFrame:
    """Per node the ``m`` features of smallest hash(seed, keys, feature) → ``(keys, feature, frank)``."""
    m = n_features(max_features, d)
    t = nodes.select(*keys).withColumn("feature", F.explode(F.sequence(F.lit(0), F.lit(d - 1))))
    h = portable_hash(F.lit(seed), F.lit("feat"), *[F.col(k) for k in keys], F.col("feature"))
    w = Window.partitionBy(*keys).orderBy(h, F.col("feature"))        # d rows per node
    t = t.withColumn("frank", F.row_number().over(w))
    return t.where(F.col("frank") <= m)
