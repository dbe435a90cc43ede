"""Operator 3: quality classifier, histogram gradient-boosted trees over document statistics.

Every document's statistics are computed in one pass over the whole texts.  The trees are grown with
logistic loss from histograms of quantile bins on a bounded sample of labelled rows
(``SAMPLE_ROWS``, the smallest hashes of the ids), then flattened into complete-tree arrays
that NumPy walks for a whole batch at once.

Defined results: a null or empty text has all statistics 0 and gets a score like any other; a null
``doc_id`` is scored and never held out or learned from; labels that are null, or whose ``doc_id``
is, are left out; without two classes among the labels, every score is the share of label 1 (0.5
without labels).  Extra columns are ignored; each row gives one row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecstack.llm.common import cut_lineage, texts

SAMPLE_ROWS = 20_000
TREES, DEPTH, RATE, BINS, L2, MIN_ROWS = 150, 4, 0.1, 64, 1.0, 10
KEEP = 0.7


def document_features(docs: DataFrame) -> DataFrame:
    """``(doc_id, features ARRAY<DOUBLE>)`` of every row of ``docs(doc_id, text)``."""
    def run(parts):
        import pandas as pd

        from vecstack.llm.textstats import quality_features
        from vecstack.llm.words import Block, blocks, encode
        for pdf in parts:
            raw = encode(pdf["text"])
            for i, j in blocks(raw):
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[i:j],
                                    "features": list(quality_features(Block(raw[i:j], lower=False))[1])})

    return texts(docs).mapInPandas(run, "doc_id bigint, features array<double>")


class BoostedTrees:
    """Complete trees of one depth in flat arrays: ``feature``, ``cut`` (inner nodes), ``leaf``."""

    def __init__(self, start: float, feature, cut, leaf):
        self.start, self.feature, self.cut, self.leaf = start, feature, cut, leaf

    def scores(self, x):
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(len(leaf).bit_length() - 1):     # the depth
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            total += leaf[at - len(feature)]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -40, 40)))


def fit_trees(x, y, trees=TREES, depth=DEPTH, rate=RATE, bins=BINS, l2=L2, min_rows=MIN_ROWS) -> BoostedTrees:
    """Boosted trees with logistic loss from per-node histograms of gradients."""
    share = float(np.mean(y)) if len(y) else 0.5
    inner = 2 ** depth - 1
    none = BoostedTrees(float(np.log((share + 1e-9) / (1 - share + 1e-9))), *[np.zeros((0, 0))] * 3)
    if share in (0.0, 1.0) or not len(y):
        return none
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    code = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    slot = np.arange(k) * bins + code                       # (row, feature) -> histogram cell
    total = np.full(n, none.start)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            cell = ((at - first)[:, None] * (k * bins) + slot).ravel()
            size = width * k * bins
            hist = lambda w: np.bincount(cell, None if w is None else np.repeat(w, k), size).reshape(width, k, bins)  # noqa: E731, B023
            gl, hl, nl = (np.cumsum(hist(w), axis=2) for w in (grad, hess, None))
            g, h, m = gl[:, :, -1:], hl[:, :, -1:], nl[:, :, -1:]
            gain = gl ** 2 / (hl + l2) + (g - gl) ** 2 / (h - hl + l2) - g ** 2 / (h + l2)
            gain[(nl < min_rows) | (m - nl < min_rows)] = -1
            flat = gain.reshape(width, -1)
            best = flat.argmax(axis=1)
            for node in np.flatnonzero(flat[np.arange(width), best] > 1e-9):
                j, b = divmod(int(best[node]), bins)
                if b < len(cuts[j]):
                    feature[first + node], cut[first + node] = j, cuts[j][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > cut[at])
        leaf_at = at - inner
        gsum, hsum = np.bincount(leaf_at, grad, inner + 1), np.bincount(leaf_at, hess, inner + 1)
        leaf = rate * gsum / (hsum + l2)
        total += leaf[leaf_at]
        features.append(feature)
        thresholds.append(cut)
        leaves.append(leaf)
    return BoostedTrees(none.start, np.array(features), np.array(thresholds), np.array(leaves))


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(features: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> BoostedTrees:
    """Fit on at most ``sample_rows`` labelled documents that are not held out."""
    known = labels.where("doc_id is not null and quality is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    known = known.where(~held_out()).groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = features.join(F.broadcast(chosen), "doc_id").orderBy("doc_id").select("features", "y").limit(sample_rows).toPandas()
    x = np.array(rows["features"].tolist(), float) if len(rows) else np.zeros((0, 1))
    return fit_trees(x, rows["y"].to_numpy(float))


def score(features: DataFrame, model: BoostedTrees, keep: float = KEEP) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``features``."""
    shared = features.sparkSession.sparkContext.broadcast(model)

    def run(parts):
        import pandas as pd
        for pdf in parts:
            if len(pdf):
                s = shared.value.scores(np.array(pdf["features"].tolist(), float))
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": s, "predicted": (s >= keep).astype(np.int32)})

    return (features.mapInPandas(run, "doc_id bigint, score double, predicted int")
            .select("doc_id", held_out().alias("held_out"), "score", "predicted"))


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Train on ``labels(doc_id, quality)`` and score every row of ``docs``."""
    features = cut_lineage(document_features(docs))
    return score(features, train(features, labels, sample_rows))
