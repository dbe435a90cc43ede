"""Histogram engine for trees grown together (M5, M7, M10), ``thresholds='hist'``.

The split candidates are the percentiles of every feature over all rows, found once; every value
becomes the number of candidates below it (one byte).  The binned matrix is written once, feature by feature, in
blocks of rows with their labels, keys and per-tree weights, and is only read afterwards.  A level of
all trees is one job: a task walks its blocks' rows to their nodes (the splits so far travel with it), counts
(node, feature, bin, class) for its open nodes, and emits each node's counts as sparse arrays; the nodes' counts are
added up, spread evenly over tasks, and give the best split and the class counts of both children.  Nothing that
grows with the rows is shuffled, and no percentile is taken below the root.  Where nodes look at all features, only the
smaller of two open siblings is counted; the larger one is its parent less the smaller one.

Majorities tied between classes go to the class of the smallest key, as elsewhere: one job at the end finds these keys.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecstack.operators.ranges import values_at
from vecstack.operators.sampling import n_features
from vecstack.operators.trees import GAIN_DECIMALS, MIN_GAIN, TreeEnsemble, TreeParams, candidate_features, quantile_fractions

BLOCK = 4096               # rows of a block
MAX_BINS = 255             # candidates of a feature
MAX_WEIGHT = 65535         # largest multiplicity of a row in a tree
TASK_CELLS = 1 << 23       # counters of one task at a time (64 MiB); more trees take more jobs
MERGE_CELLS = 1 << 21      # counters that one merging task holds
DRIVER_HASHES = 200_000    # (node, feature) hashes taken on the driver; more are a job


class Binned:
    """The binned blocks of a training set and what is needed to read them."""

    def __init__(self, blocks: DataFrame, edges: list, classes: list, n_weights: int):
        self.blocks, self.edges, self.classes, self.n_weights = blocks, edges, classes, n_weights

    def release(self):
        self.blocks.unpersist()


def feature_edges(rows: DataFrame, d: int, params: TreeParams, features: str = "features") -> list:
    """The split candidates of every feature, ascending (A3 over all rows)."""
    if not 0 < params.n_thresholds <= MAX_BINS - 1:
        raise ValueError(f"the histogram engine takes 1 to {MAX_BINS - 1} candidates a feature")
    x = F.col("x") if params.decimals is None else F.round("x", params.decimals)
    long = rows.select(F.posexplode(features).alias("feature", "x")).select("feature", x.alias("x"), F.lit(1).cast("bigint").alias("w"))
    got = {r["feature"]: r["q"] for r in values_at(long, ["feature"], "x", "w", quantile_fractions(params.n_thresholds), d).collect()}
    cut = (lambda v: v) if params.decimals is None else (lambda v: np.round(v, params.decimals))
    return [np.unique(cut(np.array(got[f], float))) for f in range(d)]


def bin_rows(rows: DataFrame, edges: list, classes: list, params: TreeParams, weights=None, n_weights: int = 1,
             label: str = "label", features: str = "features", key: str = "row_id") -> Binned:
    """Blocks ``(n, keys, labels, bins, weights)`` of ``rows``; ``weights`` is an ``array<int>`` column (default: 1)."""
    w = weights if weights is not None else F.array(F.lit(1))
    src = rows.select(F.col(key).cast("bigint").alias("k"), F.col(label).cast("bigint").alias("y"), F.col(features).alias("x"), w.cast("array<int>").alias("w"))
    code = {int(c): i for i, c in enumerate(classes)}
    dec = params.decimals
    travelling = rows.sparkSession.sparkContext.broadcast(edges)

    def run(parts):
        cuts = travelling.value
        for pdf in parts:
            for s in range(0, len(pdf), BLOCK):
                some = pdf.iloc[s:s + BLOCK]
                x = np.vstack(some["x"].to_numpy())
                if dec is not None:
                    x = np.round(x, dec)
                weight = np.vstack(some["w"].to_numpy())
                if weight.max(initial=0) > MAX_WEIGHT:
                    raise ValueError(f"a row's multiplicity in a tree is above {MAX_WEIGHT}")
                bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(cuts)]).astype(np.uint8)
                yield pd.DataFrame({"n": [len(some)], "keys": [some["k"].to_numpy(np.int64).tobytes()],
                                    "labels": [some["y"].map(code).to_numpy(np.int32).tobytes()], "bins": [bins.tobytes()],
                                    "weights": [np.ascontiguousarray(weight.T.astype(np.uint16)).tobytes()]})

    blocks = src.mapInPandas(run, "n int, keys binary, labels binary, bins binary, weights binary").persist(StorageLevel.MEMORY_AND_DISK)
    return Binned(blocks, edges, list(classes), n_weights)


def _read(parts, d: int, n_weights: int):
    """``(keys, labels, bins [d × n], weights [n_weights × n])`` of every block."""
    for pdf in parts:
        for n, k, y, b, w in zip(pdf["n"], pdf["keys"], pdf["labels"], pdf["bins"], pdf["weights"]):
            yield (np.frombuffer(k, np.int64), np.frombuffer(y, np.int32), np.frombuffer(b, np.uint8).reshape(d, n),
                   np.frombuffer(w, np.uint16).reshape(n_weights, n))


class _Splits:
    """Splits of all trees as dense arrays: ``feature[tree, node]`` (-1: none) and ``cut[tree, node]`` (bins up to it go left)."""

    def __init__(self, n_trees: int, depth: int):
        self.feature = np.full((n_trees, 1 << depth), -1, np.int32)
        self.cut = np.zeros((n_trees, 1 << depth), np.int16)

    def nodes(self, tree: int, bins, levels: int):
        """The node of every row after ``levels`` splits; 0 where a leaf came before."""
        n = bins.shape[1]
        at, row = np.ones(n, np.int64), np.arange(n)
        for _ in range(levels):
            f = self.feature[tree, at]
            at = np.where((at > 0) & (f >= 0), 2 * at + (bins[f, row] > self.cut[tree, at]), 0)
        return at


def _class_counts(binned: Binned, n_trees: int, per: int, target, d: int) -> np.ndarray:
    """Weighted class counts of every tree's root."""
    n_weights, classes = binned.n_weights, target.size

    def run(parts):
        out = np.zeros((n_trees, classes), np.int64)
        for _, y, _, w in _read(parts, d, n_weights):
            for t in range(n_trees):
                out[t] += np.bincount(target(y, t), weights=w[t // per], minlength=classes).astype(np.int64)
        yield pd.DataFrame({"t": np.repeat(np.arange(n_trees), classes), "c": np.tile(np.arange(classes), n_trees), "n": out.ravel()})

    got = binned.blocks.mapInPandas(run, "t long, c long, n long").groupBy("t", "c").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((n_trees, classes), np.int64)
    for r in got:
        counts[r["t"], r["c"]] = r["n"]
    return counts


class Target:
    """The class index that a tree learns from the label index: the label itself, or whether it is the tree's own class."""

    def __init__(self, classes: int, one_vs_rest: bool):
        self.classes, self.one_vs_rest = classes, one_vs_rest
        self.size = 2 if one_vs_rest else classes

    def __call__(self, y, tree: int):
        return (y == tree % self.classes).astype(np.int32) if self.one_vs_rest else y


def _candidates(spark, open_nodes, d: int, m: int, seed: int, name_of) -> dict:
    """``{(tree, node): features in hash order}`` (R5); ``name_of(tree)`` is the tree that the hash names."""
    if m >= d:
        every = np.arange(d)
        return {k: every for k in open_nodes}
    names = sorted({(name_of(t), n) for t, n in open_nodes})
    if len(names) * d > DRIVER_HASHES:
        found: dict = {}
        for r in candidate_features(spark.createDataFrame(names, "tree long, node long"), d, m, seed).collect():
            found.setdefault((r["tree"], r["node"]), {})[r["frank"]] = r["feature"]
        picked = {k: np.array([v[i] for i in sorted(v)]) for k, v in found.items()}
    else:
        h = lambda t, n, f: (int(hashlib.md5(f"{seed}:feat:{t}:{n}:{f}".encode()).hexdigest()[:8], 16), f)
        picked = {(t, n): np.array([f for _, f in sorted(h(t, n, f) for f in range(d))[:m]]) for t, n in names}
    return {(t, n): picked[(name_of(t), n)] for t, n in open_nodes}


def _best(hist: np.ndarray, feats: np.ndarray, edges: list, min_leaf: float):
    """The best split of a node from ``hist[feature, bin, class]``: ``(gain, place, cut, left counts)`` or None."""
    left = np.cumsum(hist, axis=1)[:, :-1].astype(np.float64)
    total = hist[0].sum(axis=0).astype(np.float64)
    right = total - left
    nl, nr = left.sum(axis=2), right.sum(axis=2)
    n, sp = total.sum(), (total * total).sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        gl = np.where(nl > 0, 1 - (left * left).sum(axis=2) / (nl * nl), 0.0)
        gr = np.where(nr > 0, 1 - (right * right).sum(axis=2) / (nr * nr), 0.0)
        gain = np.round((1 - sp / (n * n)) - nl / n * gl - nr / n * gr, GAIN_DECIMALS)
    sizes = np.array([len(edges[f]) for f in feats])
    ok = (np.arange(gain.shape[1])[None, :] < sizes[:, None]) & (nl >= min_leaf) & (nr >= min_leaf)
    gain = np.where(ok, gain, -1.0)
    at = int(gain.argmax())                                # first maximum: feature in order, then the smaller cut
    i, j = divmod(at, gain.shape[1])
    return (float(gain[i, j]), i, j, left[i, j].astype(np.int64)) if gain[i, j] > MIN_GAIN else None


def grow_hist(binned: Binned, n_trees: int, params: TreeParams, d: int, per: int = 1, one_vs_rest: bool = False,
              active=None, name_of=lambda t: t) -> TreeEnsemble:
    """Grow trees ``0 … n_trees - 1`` over binned rows.

    Tree ``t`` weighs rows by the weights ``t // per``; with ``one_vs_rest`` it learns whether the label is class
    ``t mod K``.  ``active``: trees to grow (default all).  ``name_of(t)`` names the tree in the hash that draws features."""
    spark = binned.blocks.sparkSession
    edges, n_weights = binned.edges, binned.n_weights
    m, bins = n_features(params.max_features, d), max(len(e) for e in edges) + 1
    target = Target(len(binned.classes), one_vs_rest)
    C, cells = target.size, m * bins * target.size
    label_of = [0, 1] if one_vs_rest else [int(c) for c in binned.classes]
    known = {(t, 1): c for t, c in enumerate(_class_counts(binned, n_trees, per, target, d)) if (active is None or t in set(active)) and c.sum()}
    splits = _Splits(n_trees, params.max_depth + 1)
    rows, ties, previous = [], [], None
    for depth in range(params.max_depth + 1):
        open_nodes = []
        for (t, node), c in sorted(known.items()):
            n, top = int(c.sum()), int(c.max())
            leaf = depth >= params.max_depth or n < params.min_samples_split or int((c > 0).sum()) <= 1 or n < 2 * params.min_samples_leaf
            if int((c == top).sum()) > 1:
                ties.append((t, node, np.flatnonzero(c == top)))
            rows.append({"tree": t, "node": node, "is_leaf": True, "feature": -1, "threshold": float("nan"), "pred": label_of[int(c.argmax())],
                         "n": float(n), "depth": depth, "searched": not leaf})
            if not leaf:
                open_nodes.append((t, node))
        if not open_nodes:
            break
        feats = _candidates(spark, open_nodes, d, m, params.seed, name_of)
        # of two open siblings that look at all features, only the smaller one is counted
        both = {(t, n) for t, n in open_nodes if (t, n ^ 1) in feats} if m >= d and previous is not None else set()
        derived = {(t, n) for t, n in both if (known[(t, n)].sum(), -(n & 1)) > (known[(t, n ^ 1)].sum(), -(n & 1 ^ 1))}
        best, level = {}, []
        for some in _groups([k for k in open_nodes if k not in derived], cells):
            some_feats = {k: feats[k] for k in some}
            partial = _level_counts(binned, splits, depth, some_feats, per, target, d, bins, n_weights)
            level.append(partial)
        partial = level[0]
        for p in level[1:]:
            partial = partial.unionByName(p)
        merged = _merge(partial, previous if derived else None, derived, feats, edges, params, bins, C, len(open_nodes) * cells, keep=m >= d)
        if m >= d:
            merged = merged.persist(StorageLevel.MEMORY_AND_DISK)
        for r in merged.select("tree", "node", "gain", "place", "cut", "left").collect():       # one row an open node
            if r["gain"] is not None and r["gain"] > 0:
                best[(r["tree"], r["node"])] = (r["place"], r["cut"], np.array(r["left"], np.int64))
        if previous is not None:
            previous.unpersist()
        previous = merged if m >= d else None
        at = {(r["tree"], r["node"]): r for r in rows if r["depth"] == depth}
        children = {}
        for k, (place, cut, left) in best.items():
            f = int(feats[k][place])
            at[k].update(is_leaf=False, feature=f, threshold=float(edges[f][cut]))
            splits.feature[k], splits.cut[k] = f, cut
            children[(k[0], 2 * k[1])], children[(k[0], 2 * k[1] + 1)] = left, known[k] - left
        known = children
        if not known:
            break
    if previous is not None:
        previous.unpersist()
    nodes = pd.DataFrame(rows, columns=["tree", "node", "is_leaf", "feature", "threshold", "pred", "n", "depth", "searched"])
    nodes = _untie(binned, splits, nodes, ties, per, target, d, label_of)
    return TreeEnsemble(nodes.sort_values(["tree", "node"]).reset_index(drop=True), params, [0, 1] if one_vs_rest else list(binned.classes))


def _groups(nodes, cells: int):
    """Nodes in groups whose counters fit a task."""
    most = max(1, TASK_CELLS // cells)
    return [nodes[i:i + most] for i in range(0, len(nodes), most)]


def _level_counts(binned: Binned, splits: _Splits, depth: int, feats: dict, per: int, target: Target, d: int, bins: int, n_weights: int) -> DataFrame:
    """``(tree, node, idx, cnt)``: each task's counts of its nodes as sparse arrays over ``(feature place, bin, class)``."""
    trees: dict = {}
    for t, node in feats:
        trees.setdefault(t, []).append(node)
    base, C = 1 << depth, target.size
    shared = binned.blocks.sparkSession.sparkContext.broadcast((splits, {t: (np.array(ns), np.stack([feats[(t, n)] for n in ns])) for t, ns in trees.items()}))

    def run(parts):
        cut, work = shared.value
        m = next(iter(work.values()))[1].shape[1]
        counts = {t: np.zeros(len(ns) * m * bins * C, np.int64) for t, (ns, _) in work.items()}
        for _, y, b, w in _read(parts, d, n_weights):
            for t, (ns, fs) in work.items():
                slot_of = np.full(base, -1, np.int64)
                slot_of[ns - base] = np.arange(len(ns))
                weight = w[t // per]
                at = cut.nodes(t, b, depth)
                row = np.flatnonzero((at >= base) & (weight > 0))
                slot = slot_of[at[row] - base]
                row, slot = row[slot >= 0], slot[slot >= 0]
                if len(row):
                    place = slot[:, None] * m + np.arange(m)[None, :]
                    idx = (place * bins + b[fs[slot], row[:, None]]) * C + target(y[row], t)[:, None]
                    counts[t] += np.bincount(idx.ravel(), weights=np.repeat(weight[row], m), minlength=len(counts[t])).astype(np.int64)
        for t, (ns, _) in work.items():
            by_node = counts[t].reshape(len(ns), -1)
            use = [(int(n), np.flatnonzero(h)) for n, h in zip(ns, by_node)]
            use = [(n, i, by_node[j][i]) for j, (n, i) in enumerate(use) if len(i)]
            if use:
                yield pd.DataFrame({"tree": t, "node": [n for n, _, _ in use], "idx": [i.astype(np.int32) for _, i, _ in use], "cnt": [c for _, _, c in use]})

    return binned.blocks.mapInPandas(run, "tree long, node long, idx array<int>, cnt array<long>")


def _merge(partial: DataFrame, parents: DataFrame | None, derived: set, feats: dict, edges: list, params: TreeParams, bins: int, C: int, cells: int,
           keep: bool) -> DataFrame:
    """Add up the tasks' counts of each node and find its best split: ``(tree, node, gain, place, cut, left[, hist])``.

    Siblings meet in one task; those in ``derived`` are their parent's counts less the sibling's."""
    spark = partial.sparkSession
    tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(cells / 65536)), math.ceil(cells / MERGE_CELLS))
    rows = partial.withColumn("hist", F.lit(None).cast("binary"))
    if parents is not None:
        up = parents.select("tree", "node", F.lit(None).cast("array<int>").alias("idx"), F.lit(None).cast("array<long>").alias("cnt"), "hist")
        rows = rows.withColumn("up", F.shiftright("node", 1)).unionByName(up.withColumn("up", F.col("node")))
    else:
        rows = rows.withColumn("up", F.shiftright("node", 1))
    m = len(next(iter(feats.values())))
    min_leaf = float(params.min_samples_leaf)
    shared = spark.sparkContext.broadcast((feats, edges, derived))

    def run(parts):
        feats, edges, derived = shared.value
        own, whole = {}, {}
        for pdf in parts:
            for t, n, idx, cnt, hist in zip(pdf["tree"], pdf["node"], pdf["idx"], pdf["cnt"], pdf["hist"]):
                if hist is not None:
                    whole[(t, n)] = np.frombuffer(hist, np.int64)
                    continue
                h = own.setdefault((t, n), np.zeros(m * bins * C, np.int64))
                h[np.asarray(idx)] += np.asarray(cnt)
        for t, n in list(own):
            if (t, n ^ 1) in derived:
                own[(t, n ^ 1)] = whole[(t, n >> 1)] - own[(t, n)]
        out = []
        for (t, n), h in own.items():
            found = _best(h.reshape(m, bins, C), feats[(t, n)], edges, min_leaf)
            gain, place, cut, left = found if found else (None, None, None, None)
            out.append((t, n, gain, place, cut, None if left is None else left.tolist(), h.tobytes() if keep else None))
        names = ["tree", "node", "gain", "place", "cut", "left", "hist"]
        yield pd.DataFrame(out, columns=names).astype({"gain": "float64", "place": "Int64", "cut": "Int64"})

    return rows.repartition(tasks, "tree", "up").select("tree", "node", "idx", "cnt", "hist").mapInPandas(
        run, "tree long, node long, gain double, place long, cut long, left array<long>, hist binary")


def _untie(binned: Binned, splits: _Splits, nodes: pd.DataFrame, ties: list, per: int, target: Target, d: int, label_of) -> pd.DataFrame:
    """Majorities shared by several classes go to the class of the smallest key in the node."""
    if not ties:
        return nodes
    n_weights, C = binned.n_weights, target.size
    work: dict = {}
    for t, node, _ in ties:
        work.setdefault((t, node.bit_length() - 1), []).append(node)
    shared = binned.blocks.sparkSession.sparkContext.broadcast((splits, {k: np.array(sorted(v)) for k, v in work.items()}))

    def run(parts):
        cut, asked = shared.value
        none = np.iinfo(np.int64).max
        first = {k: np.full(len(ns) * C, none) for k, ns in asked.items()}
        for key, y, b, w in _read(parts, d, n_weights):
            for (t, depth), ns in asked.items():
                at = cut.nodes(t, b, depth)
                place = np.minimum(np.searchsorted(ns, at), len(ns) - 1)
                row = np.flatnonzero((ns[place] == at) & (w[t // per] > 0))
                np.minimum.at(first[(t, depth)], place[row] * C + target(y[row], t), key[row])
        for (t, depth), ns in asked.items():
            at = np.flatnonzero(first[(t, depth)] < none)
            yield pd.DataFrame({"tree": t, "node": ns[at // C], "c": at % C, "k": first[(t, depth)][at]})

    got = binned.blocks.mapInPandas(run, "tree long, node long, c long, k long").groupBy("tree", "node", "c").agg(F.min("k").alias("k")).collect()
    key = {(r["tree"], r["node"], r["c"]): r["k"] for r in got}
    winner = {(t, node): label_of[min(cs, key=lambda c: key[(t, node, int(c))])] for t, node, cs in ties}
    nodes["pred"] = [winner.get((t, n), p) for t, n, p in zip(nodes["tree"], nodes["node"], nodes["pred"])]
    return nodes


def fit_hist(rows: DataFrame, n_trees: int, params: TreeParams, d: int, classes, weights=None, n_weights: int = 1, per: int | None = None,
             one_vs_rest: bool = False, active=None, name_of=lambda t: t, label: str = "label", features: str = "features", key: str = "row_id") -> TreeEnsemble:
    """Bin ``rows`` and grow: ``weights`` is an ``array<int>`` column of ``n_weights`` entries, one for each ``per`` trees."""
    per = per or max(1, n_trees // n_weights)
    binned = bin_rows(rows, feature_edges(rows, d, params, features), list(classes), params, weights, n_weights, label, features, key)
    try:
        return grow_hist(binned, n_trees, params, d, per, one_vs_rest, active, name_of)
    finally:
        binned.release()
