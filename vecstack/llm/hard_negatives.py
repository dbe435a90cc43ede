"""Operator 12: hard-negative mining with Kronecker-packed products.

Vectors become integers (``floor(256 x)`` of each component).  For a block of candidates every component
is biased to be non-negative, and the components of several candidates are put into separated bit
fields of one wide integer, field width enough for the largest inner product.  One
multiplication by an anchor's (biased) component then multiplies all of them; the sum over the components
holds one exact inner product in each field, from which the bias is taken off again.  Wide integers of up
to 53 bits are carried in doubles, where sums of integers are exact, so that a block of packed candidates
meets a block of anchors in one matrix product; wider fields use integers of any length.

Anchors are a stated query set (ids divisible by ``EVERY``): they travel in blocks of at most ``ANCHORS`` rows and
meet every row.  A first pass keeps each anchor's best rows of its own label (its positives), a second one
its best rows of other labels inside each positive's window; tasks keep running lists of fixed
length, and the last step ranks the tasks' lists.

Defined results: rows with a null label or vector, a null or non-finite component, or a null ``vec_id`` take no
part; rows sharing a ``vec_id`` count once, as the smallest (label, components).  Vectors of different lengths are filled up with zeros.
Ties go to the smaller ``vec_id``.  Components and scores beyond 64 bits saturate.  An anchor without positives, and a positive without rows in its
window, give no rows.  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecstack.llm.common import materialise

EVERY, POSITIVES, NEGATIVES, LOW, HIGH = 100, 5, 10, 30, 90
ANCHORS = 8192             # anchors of one broadcast (8 bytes a component)
BLOCK_ROWS = 8192          # candidate rows of one task
WORD = 53                  # bits of an integer that a double holds exactly
_TILE = 256                # anchors whose scores are held at once
_NO_ID = np.iinfo(np.int64).max
_FREE = -_NO_ID


def integers(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, c array<bigint>)`` of the rows that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where("vec_id is not null and label is not null and embedding is not null").where(whole)
    label = F.col("label").cast("bigint")
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                       F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                       F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double"))).alias("c"))


def _field_bits(c, a) -> int:
    """Bits that hold any inner product of rows of ``c`` and ``a`` (both non-negative)."""
    return max(1, (int(c.max(initial=0)) * int(a.max(initial=0)) * c.shape[1]).bit_length())


def packed_products(c, a):
    """Inner products of all rows of ``a`` with all rows of ``c`` (integers), exactly: ``len(a) x len(c)``."""
    n, d = c.shape
    if not n or not d or not len(a):
        return np.zeros((len(a), n), np.int64)
    low_c, low_a = int(c.min()), int(a.min())
    span = max(int(c.max()) - low_c, int(a.max()) - low_a)
    if span >= 1 << 62:
        c, a = c.astype(object), a.astype(object)
    c, a = c - low_c, a - low_a
    bits = _field_bits(c, a)
    if bits > WORD:
        fields = _wide(c, a, bits)
    else:
        per = WORD // bits
        filled = np.zeros((-(-n // per) * per, d), np.int64)
        filled[:n] = c
        word = sum(filled[j::per] << (bits * j) for j in range(per))
        product = (a.astype(np.float64) @ word.astype(np.float64).T).astype(np.int64)
        fields = np.empty((len(a), len(filled)), np.int64)
        for j in range(per):
            fields[:, j::per] = (product >> (bits * j)) & ((1 << bits) - 1)
        fields = fields[:, :n]
    # (a + low_a)(c + low_c) summed over the components
    if bits + max(abs(low_c).bit_length(), abs(low_a).bit_length()) + int(d).bit_length() > 61:
        c, a, fields = c.astype(object), a.astype(object), fields.astype(object)
    out = fields + low_c * a.sum(axis=1)[:, None] + low_a * c.sum(axis=1)[None, :] + d * low_a * low_c
    return np.clip(out, 1 + _FREE, _NO_ID - 1).astype(np.int64) if out.dtype == object else out


def _wide(c, a, bits: int, per: int = 64):
    """The products of non-negative rows, with ``per`` fields in an integer of any length."""
    out = np.empty((len(a), len(c)), object)
    mask = (1 << bits) - 1
    for s in range(0, len(c), per):
        rows = c[s:s + per]
        words = [sum(int(x) << (bits * j) for j, x in enumerate(column)) for column in rows.T]
        for t, anchor in enumerate(a):
            total = sum(int(x) * w for x, w in zip(anchor, words))
            out[t, s:s + len(rows)] = [(total >> (bits * j)) & mask for j in range(len(rows))]
    return out


def _matrix(column, d: int | None = None):
    """Rows of components as one array, filled up with zeros to the longest (or ``d``)."""
    rows = [np.asarray(v, np.int64) for v in column]
    out = np.zeros((len(rows), max([len(v) for v in rows] + [d or 0])), np.int64)
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out


class _Best:
    """The ``k`` best of each row, by score and then by id; the score ``_FREE`` marks a free place."""

    def __init__(self, rows: int, k: int):
        self.score = np.full((rows, k), _FREE)
        self.id = np.full((rows, k), _NO_ID)

    def add(self, at, score, ok, ids):
        """Offer ``score`` (rows x candidates), where ``ok``, to the rows ``at``; ``ids`` ascend."""
        ok = ok & (score >= self.score[at, -1][:, None])
        use = np.flatnonzero(ok.any(axis=1))
        if not len(use):
            return
        at, ok = at[use], ok[use]
        score = np.where(ok, score[use], _FREE)
        n = score.shape[1]
        k = min(self.score.shape[1], n)
        largest = np.abs(score, where=ok, out=np.zeros_like(score)).max()
        if largest < (1 << 62) // n:                       # score and place in one number
            key = np.where(ok, score * n + (n - 1 - np.arange(n)), _FREE)
            pick = np.argpartition(key, n - k, axis=1)[:, n - k:]
        else:
            pick = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :k]
        found = np.take_along_axis(score, pick, axis=1)
        s = np.concatenate([self.score[at], found], axis=1)
        i = np.concatenate([self.id[at], np.where(found == _FREE, _NO_ID, ids[pick])], axis=1)
        by = np.lexsort((i, -s), axis=1)[:, :self.score.shape[1]]
        self.score[at], self.id[at] = np.take_along_axis(s, by, axis=1), np.take_along_axis(i, by, axis=1)


def _tiles(parts, anchors):
    """``(tile, its rows of anchors, candidate ids, labels, scores)`` for every block of candidates."""
    d = anchors["c"].shape[1]
    for pdf in parts:
        for s in range(0, len(pdf), BLOCK_ROWS):
            block = pdf.iloc[s:s + BLOCK_ROWS].sort_values("vec_id")
            ids, label, c = block["vec_id"].to_numpy(np.int64), block["label"].to_numpy(np.int64), _matrix(block["c"], d)
            for t in range(0, len(anchors["id"]), _TILE):
                at = np.arange(t, min(t + _TILE, len(anchors["id"])))
                a = anchors["c"][at]
                a = np.pad(a, ((0, 0), (0, c.shape[1] - a.shape[1])))
                yield at, ids, label, packed_products(c, a)


def _kept(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    """The ``k`` best rows of each key, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _positives(rows: DataFrame, shared, k: int) -> DataFrame:
    """``(anchor_id, rank, other, score)``: the best rows of each anchor's own label."""
    def run(parts):
        import pandas as pd
        anchors = shared.value
        best = _Best(len(anchors["id"]), k)
        for at, ids, label, score in _tiles(parts, anchors):
            best.add(at, score, (anchors["label"][at][:, None] == label) & (anchors["id"][at][:, None] != ids), ids)
        x, y = np.nonzero(best.id != _NO_ID)
        yield pd.DataFrame({"anchor_id": anchors["id"][x], "other": best.id[x, y], "score": best.score[x, y]})

    return _kept(rows.mapInPandas(run, "anchor_id bigint, other bigint, score bigint"), k, "anchor_id")


def _negatives(rows: DataFrame, shared, k: int) -> DataFrame:
    """The best rows of other labels in the window of each ``(anchor, positive)``."""
    def run(parts):
        import pandas as pd
        anchors = shared.value
        low, high, places = anchors["low"], anchors["high"], anchors["positive"].shape[1]
        best = [_Best(len(anchors["id"]), k) for _ in range(places)]
        for at, ids, label, score in _tiles(parts, anchors):
            other = anchors["label"][at][:, None] != label
            for p in range(places):
                best[p].add(at, score, other & (score >= low[at, p][:, None]) & (score <= high[at, p][:, None]), ids)
        for p in range(places):
            x, y = np.nonzero(best[p].id != _NO_ID)
            yield pd.DataFrame({"anchor_id": anchors["id"][x], "positive_id": anchors["positive"][x, p], "other": best[p].id[x, y],
                                "score": best[p].score[x, y], "positive_score": anchors["score"][x, p]})

    found = rows.mapInPandas(run, "anchor_id bigint, positive_id bigint, other bigint, score bigint, positive_score bigint")
    return _kept(found, k, "anchor_id", "positive_id")


def mine(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         every: int = EVERY) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for each anchor and
    positive the first ``negatives`` rows of other labels with ``low * positive <= 100 * negative <= high * positive``."""
    spark = vectors.sparkSession
    tasks = max(1, math.ceil(vectors.select("vec_id").count() / BLOCK_ROWS))
    rows = integers(vectors).groupBy("vec_id").agg(F.min(F.struct("label", "c")).alias("r")).select("vec_id", "r.*")
    rows = materialise(rows.repartition(tasks, "vec_id"))
    anchors = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, math.ceil(anchors.count() / ANCHORS))
    out = None
    for b in range(blocks):
        block = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toPandas()      # about ANCHORS rows
        state = {"id": block["vec_id"].to_numpy(np.int64), "label": block["label"].to_numpy(np.int64), "c": _matrix(block["c"])}
        own = _positives(rows, spark.sparkContext.broadcast(state), positives).toPandas()       # at most ``positives`` an anchor
        place = {int(i): n for n, i in enumerate(state["id"])}
        at, slot = own["anchor_id"].map(place).to_numpy(np.int64), own["rank"].to_numpy(np.int64) - 1
        shape = (len(block), positives)
        state["positive"], state["score"] = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        state["low"], state["high"] = np.full(shape, -_FREE), np.full(shape, _FREE)             # no window
        state["positive"][at, slot], state["score"][at, slot] = own["other"], own["score"]
        state["low"][at, slot] = [-(-low * int(s) // 100) for s in own["score"]]
        state["high"][at, slot] = [high * int(s) // 100 for s in own["score"]]
        found = _negatives(rows, spark.sparkContext.broadcast(state), negatives).select(
            "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        found = materialise(found) if blocks > 1 else found
        out = found if out is None else out.union(found)
    return out
