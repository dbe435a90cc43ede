"""Level-wise decision trees, hard-vote forests.

A tree is a **table** ``(tree, node, is_leaf, feature, threshold, pred, n, depth)``
with heap numbering (children of ``i`` are ``2i`` and ``2i+1``).  Fitting grows
*all* trees of an ensemble together, one level per round of Spark jobs, over a
**wide** working frame: one row per data row holding its features once, a
per-tree multiplicity array ``w[t]`` (bootstrap / subsample) and a per-tree
node array ``nd[t]`` (0 = not in tree ``t`` any more).  Per-tree targets are
computed on the fly from the label.  Nothing is copied per tree.

1. node statistics — the (tree, node) pairs are exploded inside a
   ``groupBy(tree, node, label)`` of weighted counts (bounded by trees ×
   2^depth × classes) that decides leaves (depth, size, purity) and majorities;
2. candidate features per open node (R5 hash ranking, or all);
3. split candidates — per ``(tree, node, feature)`` the distinct interpolated
   percentiles at ``linspace(0, 1, q + 2)[1:-1]`` (``percentile`` with the
   bootstrap multiplicity as frequency).  They are exact at every size: nodes of
   at most ``exact_max_rows`` weighted rows are sorted in one task, larger ones by
   range-partitioned selection that finds the same values (``operators/ranges.py``);
   ``n_thresholds <= 0`` takes every distinct value, at any size, by a prefix scan of
   class counts over value ranges; ``'approx'``
   asks for the mergeable ``percentile_approx`` sketch per node; ``'global'``
   computes the candidates once per feature over all training rows (sketch) and
   reuses them at every node, like MLlib's bins — one percentile pass per fit;
4. histogram — every (row, tree) is bucketed once per candidate feature (bucket
   = number of thresholds below the value) and counted per ``(tree, node,
   feature, bucket, label)`` with map-side combine: the shuffle is bounded by
   nodes × features × (q+1) × classes, not by rows;
5. split choice — left counts are cumulative bucket counts, right = parent −
   left, weighted Gini gain, ``min_samples_leaf`` on both sides; best per node by
   (gain desc, feature rank, threshold asc); gain ≤ 1e-12 makes a leaf;
6. rows move to children by a narrow array transform of ``nd`` that reads the
   level's splits from dense constant arrays indexed by ``t·2^L + (node − 2^L)``
   (size trees × 2^level ≤ 1M, checked; one JSON literal folded to a constant) — no join, no shuffle.

Prediction walks all trees the same way (one array transform per level).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from vecstack.functions.arrays import const_array
from vecstack.operators.ranges import running_sums, values_at, with_range
from vecstack.operators.sampling import n_features

MIN_GAIN = 1e-12
GAIN_DECIMALS = 12           # gains are compared after rounding (stable tie order)
BROADCAST_ROWS = 4_000_000   # node / split tables above this size are shuffled, not broadcast
EXACT_VALUES = 1 << 20       # values that one task sorts for the percentiles of a node, unless a single feature has more
DENSE_MAX = 1_000_000        # largest per-level lookup array (trees × 2^level): ≤ 8 MiB per task


@dataclass
class TreeParams:
    max_depth: int = 8
    min_samples_split: int = 20
    min_samples_leaf: int = 5
    max_features: object = "sqrt"
    n_thresholds: int = 16
    thresholds: str = "exact"          # 'exact' | 'approx' (sketch per node) | 'global' (sketch once per feature) | 'hist' (binned once)
    exact_max_rows: int = 1_000_000    # largest node (weighted rows) sorted in one task; larger ones give the same percentiles by a distributed sort
    decimals: int | None = None        # round values and thresholds (engine-stable comparisons)
    seed: int = 42
    approx_accuracy: int = 10_000


def quantile_fractions(q: int) -> list[float]:
    """Interior points of ``linspace(0, 1, q + 2)``."""
    return [float(v) for v in np.linspace(0.0, 1.0, q + 2)[1:-1]]


def _bc(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint only for a table whose row count is known to be small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _value(x, decimals):
    return F.round(x, decimals) if decimals is not None else x


def _lit_array(vals, kind: str):
    return const_array(vals, kind)


def _dense(n_trees: int, width: int, entries, fill, kind: str):
    """Dense constant array over ``tree × width`` slots from ``{(tree, slot): value}``."""
    size = n_trees * width
    if size > DENSE_MAX:
        raise ValueError(f"{n_trees} trees × {width} nodes per level exceed the lookup bound {DENSE_MAX}; "
                         "grow fewer trees at once or use a smaller max_depth")
    arr = np.full(size, fill, dtype=np.float64 if kind == "double" else np.int64)
    for (t, slot), v in entries.items():
        arr[t * width + slot] = v
    return _lit_array(arr.tolist(), kind)


def _walk(nd, x, feats, thrs, level: int, dec, keep_leaves: bool):
    """One level of every tree: nodes at depth ``level`` with a split move to a child;
    other nodes stay (prediction) or leave the tree (fitting, ``keep_leaves=False``)."""
    base = 1 << level

    def step(s, t):
        node, xv = s["n"], s["x"]
        idx = (t * base + node - base + 1).cast("int")
        fe = F.element_at(feats, idx)
        go = (_value(F.element_at(xv, (fe + 1).cast("int")), dec) > F.element_at(thrs, idx)).cast("long")
        stay = node if keep_leaves else F.lit(0).cast("long")
        return (F.when(node <= 0, F.lit(0).cast("long"))
                 .when(node < base, stay)
                 .when(fe < 0, stay)
                 .otherwise(node * 2 + go))

    # the features travel as a lambda argument (array_repeat keeps one reference per tree), so an
    # upstream expression for them is evaluated once per row even if the optimizer inlines it
    return F.transform(F.arrays_zip(nd.alias("n"), F.array_repeat(x, F.size(nd)).alias("x")), step)


@dataclass
class TreeEnsemble:
    nodes: pd.DataFrame                  # tree, node, is_leaf, feature, threshold, pred, n, depth, searched
    params: TreeParams
    classes: list = field(default_factory=list)

    @property
    def tree_ids(self) -> list[int]:
        return sorted(int(t) for t in self.nodes["tree"].unique())

    def nodes_frame(self, spark) -> DataFrame:
        pdf = self.nodes.copy()
        return spark.createDataFrame(pdf, "tree long, node long, is_leaf boolean, feature long, threshold double, "
                                          "pred long, n double, depth long, searched boolean")

    def searched_features(self, spark, d: int) -> DataFrame:
        """R5 for this ensemble: the candidate features of every node whose split was searched."""
        nd = self.nodes[self.nodes["searched"]][["tree", "node"]].astype("int64")
        m = n_features(self.params.max_features, d)
        return candidate_features(spark.createDataFrame(nd, "tree long, node long"), d, m, self.params.seed)

    def vote_array(self, df: DataFrame, features: str = "features", trees: list[int] | None = None,
                   out: str = "votes") -> DataFrame:
        """Appends ``out`` = ``array<long>`` of every tree's vote (index = tree id, -1 = tree not
        used) — narrow: one array transform per level plus one leaf lookup, no shuffle."""
        walked, preds, width = self._walk_frame(df, features, trees)
        votes = F.transform("_nd", lambda node, t: F.when(node > 0, F.element_at(
            preds, (t * width + node + 1).cast("int"))).otherwise(F.lit(-1).cast("long")))
        return walked.withColumn(out, votes).drop("_nd", "_x")

    def _walk_frame(self, df: DataFrame, features: str, trees):
        trees = sorted(trees if trees is not None else self.tree_ids)
        nd = self.nodes[self.nodes["tree"].isin(trees)]
        T = (max(trees) + 1) if trees else 1
        depth = int(nd["depth"].max()) if len(nd) else 0
        dec = self.params.decimals
        cur = df.withColumn("_x", F.col(features)).withColumn(
            "_nd", _lit_array([1 if t in set(trees) else 0 for t in range(T)], "bigint"))
        internal = nd[~nd["is_leaf"]]
        for level in range(depth):
            lv = internal[internal["depth"] == level]
            base = 1 << level
            feats = _dense(T, base, {(int(r.tree), int(r.node) - base): int(r.feature) for r in lv.itertuples()},
                           -1, "bigint")
            thrs = _dense(T, base, {(int(r.tree), int(r.node) - base): float(r.threshold) for r in lv.itertuples()},
                          0.0, "double")
            cur = cur.withColumn("_nd", _walk(F.col("_nd"), F.col("_x"), feats, thrs, level, dec, True))
        width = 1 << (depth + 1)
        preds = _dense(T, width, {(int(r.tree), int(r.node)): int(r.pred)
                                  for r in nd[nd["is_leaf"]].itertuples()}, -1, "bigint")
        return cur, preds, width

    def apply(self, df: DataFrame, features: str = "features", key: str = "row_id",
              trees: list[int] | None = None) -> DataFrame:
        """``(key, tree, node, vote)`` — the leaf of every row in every tree.

        One narrow array transform per level over all trees at once."""
        walked, preds, width = self._walk_frame(df.select(key, features), features, trees)
        out = walked.select(F.col(key), F.posexplode("_nd").alias("tree", "node")).where(F.col("node") > 0)
        vote = F.element_at(preds, (F.col("tree") * width + F.col("node") + 1).cast("int"))
        return out.select(key, F.col("tree").cast("long").alias("tree"), "node", vote.alias("vote"))

    def predict(self, df: DataFrame, features: str = "features", key: str = "row_id") -> DataFrame:
        """M6 / M8: hard majority over trees, ties → the vote of the lowest tree id (``(key, pred)``)."""
        return self.predict_column(df.select(key, features), features).select(key, "pred")

    def tables(self, trees: list[int] | None = None) -> "Tables":
        return Tables(self, sorted(trees if trees is not None else self.tree_ids))

    def predict_column(self, df: DataFrame, features: str = "features", out: str = "pred") -> DataFrame:
        """``df`` with the hard-majority class appended (narrow: a batch of rows walks all trees at once; ties go
        to the class of the lowest tree among them)."""
        shared = df.sparkSession.sparkContext.broadcast(self.tables())
        schema = StructType([*df.schema.fields, StructField(out, IntegerType())])

        def run(parts):
            for pdf in parts:
                pred = [shared.value.majority(shared.value.votes(x)) for x in row_chunks(pdf[features], shared.value.n_trees)]
                yield pdf.assign(**{out: np.concatenate(pred).astype(np.int32) if pred else np.zeros(0, np.int32)})

        return df.mapInPandas(run, schema)

    def predict_column_sql(self, df: DataFrame, features: str = "features", out: str = "pred") -> DataFrame:
        """The same by column functions (per row, every class gets (count of its votes, −first tree voting
        for it) and the largest pair wins)."""
        classes = sorted(set(int(v) for v in self.nodes["pred"].unique()))
        v = self.vote_array(df, features)
        cls = F.array(*[F.lit(c).cast("long") for c in classes])
        big = F.lit(1 << 40)

        def score(c, vs):
            cnt = F.size(F.filter(vs, lambda x: x == c))
            first = F.array_position(vs, c)                # 1-based position = tree id + 1
            return F.struct(cnt.alias("n"), (big - first).alias("f"), c.alias("c"))

        per_class = F.zip_with(cls, F.array_repeat(F.col("votes"), len(classes)), score)
        best = F.array_max(F.filter(per_class, lambda s: s["n"] > 0))
        return v.withColumn(out, best["c"].cast("int")).drop("votes")


class Tables:
    """Trees as dense arrays over (tree, heap node), for walking whole batches of rows."""

    def __init__(self, ensemble: TreeEnsemble, trees: list[int]):
        nd = ensemble.nodes[ensemble.nodes["tree"].isin(trees)]
        self.depth = int(nd["depth"].max()) if len(nd) else 0
        self.n_trees, self.decimals = len(trees), ensemble.params.decimals
        if len(trees) << (self.depth + 1) > 16 * DENSE_MAX:
            raise ValueError(f"{len(trees)} trees of depth {self.depth} exceed the lookup bound {16 * DENSE_MAX}")
        shape = (max(1, len(trees)), 1 << (self.depth + 1))
        self.feature, self.threshold, self.pred = np.full(shape, -1, np.int32), np.zeros(shape), np.full(shape, -1, np.int64)
        at = (nd["tree"].map({t: i for i, t in enumerate(trees)}).to_numpy(np.int64), nd["node"].to_numpy(np.int64))
        leaf = nd["is_leaf"].to_numpy(bool)
        self.feature[at] = np.where(leaf, -1, nd["feature"].to_numpy())
        self.threshold[at] = np.where(leaf, 0.0, nd["threshold"].to_numpy(float))
        self.pred[at] = nd["pred"].to_numpy(np.int64)

    def votes(self, x: np.ndarray) -> np.ndarray:
        """``rows × trees``: the class of the leaf of every row in every tree."""
        if self.decimals is not None:
            x = np.round(x, self.decimals)
        tree, row = np.arange(self.n_trees)[None, :], np.arange(len(x))[:, None]
        at = np.ones((len(x), self.n_trees), np.int64)
        for _ in range(self.depth):
            f = self.feature[tree, at]
            at = np.where(f >= 0, 2 * at + (x[row, f] > self.threshold[tree, at]), at)
        return self.pred[tree, at]

    @staticmethod
    def majority(votes: np.ndarray) -> np.ndarray:
        classes = np.unique(votes)
        same = votes[:, :, None] == classes[None, None, :]
        count, first = same.sum(axis=1), same.argmax(axis=1)
        best = np.where(count == count.max(axis=1, keepdims=True), first, votes.shape[1])
        return classes[best.argmin(axis=1)]


def row_chunks(features, n_trees: int):
    """Feature rows of a batch as matrices whose walk stays small."""
    step = max(1, 2_000_000 // max(n_trees, 1))
    for i in range(0, len(features), step):
        yield np.vstack([np.asarray(v, float) for v in features.iloc[i:i + step]])


def _tree_view(cur: DataFrame, target) -> DataFrame:
    """``(_k, _x, tree, node, w, label)`` for every (row, tree) still in a node with weight > 0."""
    v = cur.select("_k", "_x", "_lab", F.posexplode(F.arrays_zip("_nd", "_w")).alias("tree", "s"))
    v = v.where((F.col("s._nd") > 0) & (F.col("s._w") > 0))
    lab = target(F.col("_lab"), F.col("tree")) if target is not None else F.col("_lab")
    return v.select("_k", "_x", F.col("tree").cast("long").alias("tree"), F.col("s._nd").alias("node"),
                    F.col("s._w").cast("long").alias("w"), lab.cast("long").alias("label"))


def grow(rows: DataFrame, n_trees: int, params: TreeParams, d: int, classes=None, weights=None, target=None,
         active=None, label: str = "label", features: str = "features", key: str = "row_id") -> TreeEnsemble:
    """M5 / M7 core: grow trees ``0 … n_trees−1`` together over one row per data row.

    ``weights``: ``array<int>`` column of per-tree multiplicities (default 1);
    ``target(label_col, tree_col)``: per-tree target (default the label);
    ``active``: tree ids to grow (default all)."""
    spark = rows.sparkSession
    fr = quantile_fractions(params.n_thresholds)
    dec = params.decimals
    m = n_features(params.max_features, d)
    act = set(range(n_trees)) if active is None else set(int(t) for t in active)
    w = weights if weights is not None else F.array_repeat(F.lit(1), n_trees)
    nd0 = _lit_array([1 if t in act else 0 for t in range(n_trees)], "bigint")
    cur = rows.select(F.col(key).alias("_k"), F.col(label).cast("long").alias("_lab"),
                      F.col(features).alias("_x"), w.cast("array<int>").alias("_w"))
    cur = cur.withColumn("_nd", F.zip_with(nd0, "_w", lambda n, ww: F.when(ww > 0, n).otherwise(F.lit(0).cast("long"))))
    cur = cur.persist(StorageLevel.MEMORY_AND_DISK)
    global_ths = None
    if params.thresholds == "global":
        gp = TreeParams(**{**params.__dict__, "thresholds": "approx"})
        global_ths = (split_candidates(cur.select(F.col("_x").alias("f")), gp, "f")
                      .groupBy("feature").agg(F.array_sort(F.collect_set("threshold")).alias("ths"))
                      .select(F.col("feature").cast("long").alias("feature"), "ths")).persist()
    out_rows = []
    prev = None
    for depth in range(params.max_depth + 1):
        view = _tree_view(cur, target)
        stats = (view.groupBy("tree", "node", "label")
                     .agg(F.sum("w").alias("cnt"), F.min("_k").alias("first")).toPandas())
        if prev is not None:                          # the child level is materialised now
            prev.unpersist()
            prev = None
        if stats.empty:
            break
        node_rows, open_nodes = _node_summaries(stats, depth, params)
        if not open_nodes:
            out_rows += node_rows
            break
        best = _best_splits(spark, view, stats, open_nodes, params, fr, dec, d, m, global_ths)
        splits = {}
        for r in node_rows:
            b = best.get((r["tree"], r["node"])) if not r["is_leaf"] else None
            if b is None:
                r["is_leaf"] = True
            else:
                r["feature"], r["threshold"] = int(b[0]), float(b[1])
                splits[(r["tree"], r["node"])] = (int(b[0]), float(b[1]))
        out_rows += node_rows
        if not splits or depth == params.max_depth:
            break
        base = 1 << depth
        feats = _dense(n_trees, base, {(t, n - base): v[0] for (t, n), v in splits.items()}, -1, "bigint")
        thrs = _dense(n_trees, base, {(t, n - base): v[1] for (t, n), v in splits.items()}, 0.0, "double")
        nxt = cur.withColumn("_nd", _walk(F.col("_nd"), F.col("_x"), feats, thrs, depth, dec, False))
        prev, cur = cur, nxt.persist(StorageLevel.MEMORY_AND_DISK)
    cur.unpersist()
    if prev is not None:
        prev.unpersist()
    if global_ths is not None:
        global_ths.unpersist()
    nodes = pd.DataFrame(out_rows, columns=["tree", "node", "is_leaf", "feature", "threshold", "pred", "n", "depth",
                                            "searched"])
    return TreeEnsemble(nodes.sort_values(["tree", "node"]).reset_index(drop=True), params,
                        list(classes) if classes is not None else [])


def _node_summaries(stats: pd.DataFrame, depth: int, p: TreeParams):
    """Leaf decisions and majorities from ``(tree, node, label, cnt, first)`` (driver, bounded)."""
    rows, open_nodes = [], []
    for (t, nd), g in stats.groupby(["tree", "node"], sort=True):
        g = g.sort_values(["cnt", "first"], ascending=[False, True])
        n = float(g["cnt"].sum())
        pred = int(g["label"].iloc[0])
        pure = int((g["cnt"] > 0).sum()) <= 1
        leaf = depth >= p.max_depth or n < p.min_samples_split or pure or n < 2 * p.min_samples_leaf
        rows.append({"tree": int(t), "node": int(nd), "is_leaf": bool(leaf), "feature": -1,
                     "threshold": float("nan"), "pred": pred, "n": n, "depth": depth, "searched": not leaf})
        if not leaf:
            open_nodes.append((int(t), int(nd)))
    return rows, open_nodes


def _best_splits(spark, view: DataFrame, stats: pd.DataFrame, open_nodes, p: TreeParams, fr, dec, d, m,
                 global_ths: DataFrame | None = None):
    """A4 for every open node at once → ``{(tree, node): (feature, threshold, gain)}``."""
    sizes = stats.groupby(["tree", "node"])["cnt"].sum()
    node_sizes = {(int(t), int(n)): float(v) for (t, n), v in sizes.items()}
    open_df = spark.createDataFrame(open_nodes, "tree long, node long")
    cand = candidate_features(open_df, d, m, p.seed)
    ex = (view.join(_bc(cand, len(open_nodes) * m), ["tree", "node"])
              .select("tree", "node", "feature", "frank", "label", "w",
                      _value(F.element_at("_x", (F.col("feature") + 1).cast("int")), dec).alias("x")))
    pre = None
    if global_ths is not None:                      # bounded: open nodes × candidate features
        pre = cand.select("tree", "node", "feature").join(F.broadcast(global_ths), "feature")
    best = split_gains(ex, open_nodes, p, fr, dec, m, best_only=True, node_sizes=node_sizes, ths=pre)
    return {(int(r["tree"]), int(r["node"])): (int(r["feature"]), float(r["t"]), float(r["gain"]))
            for r in best.collect() if r["gain"] > MIN_GAIN}


def candidate_features(open_df: DataFrame, d: int, m: int, seed: int) -> DataFrame:
    """R5 per open node without a shuffle: the m features of smallest hash, via a per-node sort."""
    from vecstack.functions.hashing import portable_hash
    if m >= d:
        return open_df.withColumn("feature", F.explode(F.sequence(F.lit(0), F.lit(d - 1)).cast("array<long>"))) \
                      .withColumn("frank", F.col("feature") + 1)
    keyed = F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda f: F.struct(
        portable_hash(F.lit(seed), F.lit("feat"), F.col("tree"), F.col("node"), f).alias("h"), f.alias("f")))
    top = F.slice(F.array_sort(keyed), 1, m)
    return open_df.select("tree", "node", F.posexplode(top).alias("pos", "s")) \
                  .select("tree", "node", F.col("s.f").cast("long").alias("feature"),
                          (F.col("pos") + 1).cast("long").alias("frank"))


GAIN_SCHEMA = "tree long, node long, feature long, frank long, j long, t double, nl double, nr double, gain double"


def exact_percentiles(src: DataFrame, fr, group: list[str]) -> DataFrame:
    """Linear-interpolated percentiles at fractions ``fr`` of ``x`` (repeated ``w`` times) per
    ``(tree, node, feature)``, computed with NumPy per bounded ``group`` (callers only use it for
    groups within ``exact_max_rows``): ``(tree, node, feature, q array<double>)``."""
    fr_arr = np.asarray(fr, dtype=np.float64)

    def pct(pdf: pd.DataFrame) -> pd.DataFrame:
        w = pdf["w"].to_numpy(np.int64)
        f = np.repeat(pdf["feature"].to_numpy(np.int64), w)
        x = np.repeat(pdf["x"].to_numpy(np.float64), w)
        order = np.lexsort((x, f))
        f, x = f[order], x[order]
        feats, start, cnt = np.unique(f, return_index=True, return_counts=True)
        pos = (cnt[:, None] - 1) * fr_arr[None, :]
        lo, hi = np.floor(pos).astype(np.int64), np.ceil(pos).astype(np.int64)
        xl, xh = x[start[:, None] + lo], x[start[:, None] + hi]
        q = xl + (xh - xl) * (pos - lo)
        return pd.DataFrame({"tree": int(pdf["tree"].iloc[0]), "node": int(pdf["node"].iloc[0]),
                             "feature": feats, "q": list(q)})

    return src.groupBy(*group).applyInPandas(pct, "tree long, node long, feature long, q array<double>")


def sorted_percentiles(src: DataFrame, fr, group, n_keys: int | None = None) -> DataFrame:
    """The values of ``exact_percentiles`` for groups of any size, by range-partitioned selection."""
    return values_at(src, [*group, "feature"], "x", "w", list(fr), n_keys)


def _thresholds(ex: DataFrame, p: TreeParams, fr, open_nodes, node_sizes, m: int) -> DataFrame:
    """A3 per ``(tree, node, feature)``: percentiles sorted in one task for bounded nodes, by range-partitioned
    selection for larger ones; ``'approx'`` takes a sketch."""
    largest = max((v for v in (node_sizes or {}).values() if v <= p.exact_max_rows), default=0)
    together = int(min(16, max(1, EXACT_VALUES // max(largest, 1))))          # features of a node sorted in one task

    def exact(src):
        return exact_percentiles(src.select("tree", "node", "feature", "x", "w",
                                            (F.col("frank") / together).cast("long").alias("_chunk")),
                                 fr, ["tree", "node", "_chunk"])

    def approx(src):
        rep = src.select("tree", "node", "feature", F.explode(F.array_repeat("x", F.col("w").cast("int"))).alias("x"))
        return rep.groupBy("tree", "node", "feature").agg(F.percentile_approx("x", fr, p.approx_accuracy).alias("q"))

    if p.thresholds == "approx":
        return approx(ex)
    sizes = node_sizes or {}
    big = [f"{t}:{n}" for (t, n) in open_nodes if sizes.get((t, n), 0) > p.exact_max_rows]
    if not big:
        return exact(ex)
    by = ["tree", "node"]
    if len(big) == len(open_nodes):
        return sorted_percentiles(ex, fr, by, len(big) * m)
    is_big = F.concat_ws(":", F.col("tree"), F.col("node")).isin(big)     # few: each holds > exact_max_rows
    return exact(ex.where(~is_big)).unionByName(sorted_percentiles(ex.where(is_big), fr, by, len(big) * m))


def every_value_gains(ex: DataFrame, p: TreeParams, n_keys: int, best_only: bool) -> DataFrame:
    """A3 + A4 with every distinct value of a node as a candidate, for nodes of any size: class counts per value,
    and their running sums (a prefix scan over value ranges) as the left side of each split."""
    keys = ["tree", "node", "feature", "frank"]
    labels = sorted(r["label"] for r in ex.select("label").distinct().collect())             # one row a class
    names = [f"c{i}" for i in range(len(labels))]
    count = lambda v: F.sum(F.when(F.col("label") == v, F.col("w")).otherwise(0)).cast("double")
    rows = with_range(ex.where("w > 0"), keys, "x", n_keys=n_keys).groupBy(*keys, "rng", "x").agg(*[count(v).alias(c) for c, v in zip(names, labels)])
    rows = running_sums(rows.withColumn("one", F.lit(1).cast("bigint")), keys, "rng", "x", [*names, "one"])
    total = lambda cols: sum(cols, F.lit(0.0))
    left = [F.col(f"upto_{c}") for c in names]
    right = [F.col(f"all_{c}") - F.col(f"upto_{c}") for c in names]
    rows = rows.select(*keys, (F.col("upto_one") - 1).alias("j"), F.col("x").alias("t"), total(left).alias("nl"), total(right).alias("nr"),
                       total([c * c for c in left]).alias("sl"), total([c * c for c in right]).alias("sr"),
                       total([F.col(f"all_{c}") * F.col(f"all_{c}") for c in names]).alias("sp"))
    rows = rows.where((F.col("nl") >= float(p.min_samples_leaf)) & (F.col("nr") >= float(p.min_samples_leaf)))
    gini = lambda n, s: F.when(F.col(n) > 0, 1 - F.col(s) / (F.col(n) * F.col(n))).otherwise(0.0)
    n = F.col("nl") + F.col("nr")
    gain = (1 - F.col("sp") / (n * n)) - F.col("nl") / n * gini("nl", "sl") - F.col("nr") / n * gini("nr", "sr")
    rows = rows.select(*keys, "j", "t", "nl", "nr", F.round(gain, GAIN_DECIMALS).alias("gain"))
    if not best_only:
        return rows
    first = F.max(F.struct("gain", (-F.col("frank")).alias("o"), (-F.col("t")).alias("u"), "feature", "frank", "j", "t", "nl", "nr")).alias("b")
    return rows.groupBy("tree", "node").agg(first).select("tree", "node", *[F.col(f"b.{c}").alias(c) for c in ("feature", "frank", "j", "t", "nl", "nr", "gain")])


def split_gains(ex: DataFrame, open_nodes, p: TreeParams, fr, dec, m,
                best_only: bool = False, node_sizes: dict | None = None, ths: DataFrame | None = None) -> DataFrame:
    """A3 + A4 from ``ex(tree, node, feature, frank, label, w, x)``: admissible
    ``(tree, node, feature, frank, j, t, nl, nr, gain)`` candidates, or only the
    best one per node (gain desc, feature rank, threshold asc)."""
    n_open = len(open_nodes)
    if p.n_thresholds <= 0:
        return every_value_gains(ex, p, n_open * m, best_only)
    # A3: split candidates per (tree, node, feature) (or given, e.g. global per feature)
    if ths is None:
        ths = _thresholds(ex, p, fr, open_nodes, node_sizes, m)
        q = F.col("q") if dec is None else F.transform("q", lambda v: F.round(v, dec))
        ths = ths.select("tree", "node", "feature", F.array_sort(F.array_distinct(q)).alias("ths"))
    # A4: histogram of buckets (bucket = #thresholds < x) per class, map-side combined
    # bucket = #thresholds < x, unrolled over the at most q thresholds (codegen, no lambda)
    bucket = sum((F.coalesce(F.get(F.col("ths"), j) < F.col("x"), F.lit(False)).cast("int") for j in range(max(len(fr), 1))), F.lit(0))
    hist = (ex.join(_bc(ths, n_open * m), ["tree", "node", "feature"])
              .withColumn("b", bucket)
              .groupBy("tree", "node", "feature", "frank", "ths", "b", "label").agg(F.sum("w").alias("c")))
    min_leaf = float(p.min_samples_leaf)

    def gains(pdf: pd.DataFrame) -> pd.DataFrame:
        # one node: every candidate feature at once on a padded (feature, bucket, class) tensor
        firsts = pdf.drop_duplicates("feature")
        feats = firsts["feature"].to_numpy(np.int64)
        franks = firsts["frank"].to_numpy(np.int64)
        ths_list = [np.asarray(t, dtype=np.float64) for t in firsts["ths"]]
        nth = np.array([len(t) for t in ths_list])
        qmax = int(nth.max()) if len(nth) else 0
        ths_mat = np.full((len(feats), max(qmax, 1)), np.inf)
        for i, t in enumerate(ths_list):
            ths_mat[i, :len(t)] = t
        fi = np.searchsorted(feats, pdf["feature"].to_numpy(np.int64), sorter=np.argsort(feats))
        fi = np.argsort(feats)[fi]
        labels, li = np.unique(pdf["label"].to_numpy(), return_inverse=True)
        cnt = np.zeros((len(feats), qmax + 1, len(labels)))
        np.add.at(cnt, (fi, pdf["b"].to_numpy(), li), pdf["c"].to_numpy(dtype=np.float64))
        left = np.cumsum(cnt, axis=1)[:, :qmax]                   # x <= t_j  <=>  bucket <= j
        par = cnt.sum(axis=1)                                     # (features, classes)
        right = par[:, None, :] - left
        nl, nr = left.sum(axis=2), right.sum(axis=2)
        sl, sr = (left * left).sum(axis=2), (right * right).sum(axis=2)
        sp = (par * par).sum(axis=1)[:, None]
        n = nl + nr
        with np.errstate(divide="ignore", invalid="ignore"):
            gl = np.where(nl > 0, 1 - sl / (nl * nl), 0.0)
            gr = np.where(nr > 0, 1 - sr / (nr * nr), 0.0)
            gain = (1 - sp / (n * n)) - nl / n * gl - nr / n * gr
        ok = (np.arange(qmax)[None, :] < nth[:, None]) & (nl >= min_leaf) & (nr >= min_leaf)
        f_i, j = np.nonzero(ok)
        res = pd.DataFrame({"feature": feats[f_i], "frank": franks[f_i], "j": j, "t": ths_mat[f_i, j],
                            "nl": nl[f_i, j], "nr": nr[f_i, j], "gain": np.round(gain[f_i, j], GAIN_DECIMALS)})
        if best_only and len(res):
            res = res.sort_values(["gain", "frank", "t"], ascending=[False, True, True], kind="mergesort").head(1)
        res.insert(0, "node", pdf["node"].iloc[0])
        res.insert(0, "tree", pdf["tree"].iloc[0])
        return res.astype({"tree": "int64", "node": "int64", "feature": "int64", "frank": "int64", "j": "int64"})

    # one bounded group per node: m features × (q + 1) buckets × classes
    return hist.groupBy("tree", "node").applyInPandas(gains, GAIN_SCHEMA)


def root_split_table(df: DataFrame, params: TreeParams, label: str = "label", features: str = "features",
                     weight: str | None = None) -> DataFrame:
    """A3/A4 on one node (all rows): every admissible ``(feature, t, nl, nr, gain)`` candidate."""
    spark = df.sparkSession
    d = len(df.select(features).first()[0])
    m = n_features(params.max_features, d)
    w = F.col(weight) if weight else F.lit(1)
    cand = candidate_features(spark.createDataFrame([(0, 1)], "tree long, node long"), d, m, params.seed)
    fl = [(int(r["feature"]), int(r["frank"])) for r in cand.select("feature", "frank").collect()]
    lit = F.array(*[F.struct(F.lit(f).cast("long").alias("feature"), F.lit(k).cast("long").alias("frank"))
                    for f, k in fl])
    base = df.select(F.col(label).cast("long").alias("label"), w.cast("long").alias("w"),
                     F.col(features).alias("_x"))
    # one node: its candidate list is a literal exploded per row (no join)
    ex = base.select("label", "w", "_x", F.explode(lit).alias("_c")).select(
        F.lit(0).cast("long").alias("tree"), F.lit(1).cast("long").alias("node"),
        F.col("_c.feature").alias("feature"), F.col("_c.frank").alias("frank"), "label", "w",
        _value(F.element_at("_x", (F.col("_c.feature") + 1).cast("int")), params.decimals).alias("x"))
    sizes = None
    if params.thresholds == "exact" and params.n_thresholds > 0:
        sizes = {(0, 1): float(base.agg(F.sum("w")).first()[0] or 0)}
    return split_gains(ex, [(0, 1)], params, quantile_fractions(params.n_thresholds), params.decimals, m,
                       node_sizes=sizes)


def split_candidates(df: DataFrame, params: TreeParams, features: str = "features") -> DataFrame:
    """A3: ``(feature, threshold)`` — distinct interpolated percentiles of every feature."""
    fr = quantile_fractions(params.n_thresholds)
    d = len(df.select(features).first()[0])
    l = df.select(F.posexplode(features).alias("feature", "x"))
    if params.decimals is not None:
        l = l.withColumn("x", F.round("x", params.decimals))
    if params.thresholds in ("approx", "global"):
        q = l.groupBy("feature").agg(F.percentile_approx("x", fr, params.approx_accuracy).alias("q"))
    else:
        q = sorted_percentiles(l.select(F.col("feature").cast("long").alias("feature"), "x", F.lit(1).alias("w")), fr, [], d).select("feature", "q")
    if params.decimals is not None:
        q = q.withColumn("q", F.transform("q", lambda v: F.round(v, params.decimals)))
    return q.select("feature", F.explode(F.array_distinct("q")).alias("threshold"))


def fit_tree(df: DataFrame, params: TreeParams | None = None, label: str = "label",
             features: str = "features") -> TreeEnsemble:
    """M5: one tree on all rows (weight 1)."""
    from vecstack.operators.evaluate import distinct_labels
    params = params or TreeParams()
    d = len(df.select(features).first()[0])
    if params.thresholds == "hist":
        from vecstack.operators.histogram import fit_hist
        return fit_hist(df, 1, params, d, distinct_labels(df, label), label=label, features=features)
    return grow(df, 1, params, d, distinct_labels(df, label), label=label, features=features)


def fit_forest(df: DataFrame, n_estimators: int = 60, sample_ratio: float = 0.30, bootstrap: bool = True,
               min_rows: int = 1000, params: TreeParams | None = None, label: str = "label",
               features: str = "features") -> TreeEnsemble:
    """M7: bagged trees grown together; per-tree multiplicities from R3 (Poisson from the hash),
    or, without replacement, an exact hash subsample of min(n, max(min_rows, ratio·n)) rows."""
    from vecstack.operators.evaluate import distinct_labels
    from vecstack.operators.sampling import bootstrap_rate, bootstrap_weight_array, subsample_membership
    params = params or TreeParams()
    d = len(df.select(features).first()[0])
    n = df.count()
    if bootstrap:
        w = bootstrap_weight_array(n_estimators, bootstrap_rate(n, sample_ratio, min_rows), params.seed)
    else:
        frac = min(1.0, max(min_rows, int(sample_ratio * n)) / max(n, 1))
        w = subsample_membership(df, frac, n_estimators, seed=params.seed, n=n)
    if params.thresholds == "hist":
        from vecstack.operators.histogram import fit_hist
        return fit_hist(df, n_estimators, params, d, distinct_labels(df, label), w, n_estimators, label=label, features=features)
    return grow(df, n_estimators, params, d, distinct_labels(df, label), weights=w, label=label, features=features)


def fit_forest_folds(folded: DataFrame, cv: int, classes: list, n_estimators: int, sample_ratio: float, min_rows: int, params: TreeParams,
                     sizes: list, label: str = "label", features: str = "features", fold: str = "fold") -> list:
    """M7 for all folds at once: the forests without fold ``0 … cv - 1`` and the forest of all rows are one ensemble of the histogram
    engine, in which a row has weight 0 in the trees of its own fold.  ``sizes[f]``: rows that forest ``f`` learns from; ``classes[f]``: its classes."""
    from vecstack.operators.histogram import fit_hist
    from vecstack.operators.sampling import bootstrap_rate, bootstrap_weight_array
    d = len(folded.select(features).first()[0])

    def weights(f: int, n: int):
        drawn = bootstrap_weight_array(n_estimators, bootstrap_rate(n, sample_ratio, min_rows), params.seed)
        return F.transform(drawn, lambda w: F.when(F.col(fold) == f, 0).otherwise(w))

    own = [weights(f, n) for f, n in enumerate(sizes)]
    total = n_estimators * len(own)
    every = sorted({c for cs in classes for c in cs})
    ens = fit_hist(folded, total, params, d, every, F.concat(*own), total, name_of=lambda t: t % n_estimators, label=label, features=features)
    out = []
    for f in range(len(own)):
        nodes = ens.nodes[ens.nodes["tree"] // n_estimators == f].assign(tree=lambda x: x["tree"] % n_estimators)
        out.append(TreeEnsemble(nodes.reset_index(drop=True), params, list(classes[f])))
    return out
