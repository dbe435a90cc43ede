"""Operator 11: ranked lexical search with hashed max-sketches.

Every document gets a sketch: a row of cells, a power of two wide and at least ``CELLS`` cells for
each of its distinct terms.  Each term falls into one cell by its hash, and a cell keeps the largest
impact of its terms (the part of the score that depends on the document, before the term's weight).
A term's impact is therefore at most the value of its cell, so the weighted cells of an item's terms add
up to an upper bound of the document's score.

The items travel as one batch: a task looks the terms of all items up in the sketches of a block of
documents, which gives the bounds of all (document, item) pairs of the block.  For each item the documents
are then rescored exactly in descending order of their bounds, until the next bound is below the ``k``-th
best exact score that the task has seen.  A task keeps only these ``k`` for each item, across its blocks;
the last step ranks the tasks' lists.  No document is left out whose bound reaches the threshold, so the
result is exact.  Nothing but the statistics and those lists is shuffled.

Terms are compared by 64-bit values; only the items' terms are ever looked up, so a wrong match needs one
of the corpus' terms to collide with one of theirs (a chance of about 10^-6 for 10^10 different terms).

Defined results: null, empty and term-less texts have no terms, do not count in ``N`` and are never found;
rows with a null ``doc_id`` count in the statistics and are not ranked; rows repeating a ``doc_id`` are documents
of their own; equal scores go by ascending ``doc_id``.  Items without terms find nothing; rows
with a null ``item_id`` are left out; of rows sharing an ``item_id`` the smallest text counts.  Very long texts are
taken in pieces of about ``PIECE`` bytes cut between terms, whole.  Extra columns are ignored; empty tables give
an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP, LENGTH_PERCENT, SATURATION, SCALE = 10, 75, 8, 1_000_000_000
CELLS = 4                  # cells of a sketch for each distinct term, at least
PIECE = 1 << 22            # bytes of a text handled at once
ENTRIES = 1 << 18          # terms of the items of one batch, repeats folded (about 8 MiB broadcast)
GRID = 1 << 22             # (document, term) look-ups at once
SCHEMA = "item_id bigint, doc_id bigint, score bigint"

#: Bytes of terms, A-Z lower-cased; every other byte becomes a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))


def fold(text) -> bytes:
    """The text as bytes with lower-case terms between spaces; null is the empty text."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass").translate(_FOLD)


def _pieces(raw: bytes):
    """Parts of a folded text of about ``PIECE`` bytes, never cutting a term."""
    at = 0
    while len(raw) - at > PIECE:
        cut = raw.rfind(b" ", at, at + PIECE)
        cut = cut if cut > at else raw.find(b" ", at + PIECE)
        if cut < 0:
            break
        yield raw[at:cut]
        at = cut
    yield raw[at:]


class Counts:
    """Term counts of a block of folded texts.

    ``n``: terms of each text; ``hit_doc``, ``hit_term``, ``hit_tf``: the asked terms that occur, as indices
    into ``asked`` (sorted values); with ``all_terms`` also ``key``, ``tf``: every distinct term of every
    text, as ``doc * 2^48`` + the upper 48 bits of its value."""

    def __init__(self, raws: list[bytes], asked, all_terms: bool):
        from vecstack.llm.words import Block
        self.size = len(raws)
        whole = len(raws) == 1 and len(raws[0]) > PIECE
        parts = [Block([p], lower=False) for p in _pieces(raws[0])] if whole else [Block(raws, lower=False)]
        self.n = sum(b.counts for b in parts)
        hits, keys = [], []
        for b in parts:
            if len(asked):
                at = np.minimum(np.searchsorted(asked, b.word), len(asked) - 1)
                found = np.flatnonzero(asked[at] == b.word)
                hits.append(np.unique(b.doc[found] * len(asked) + at[found], return_counts=True))
            if all_terms:
                keys.append(np.unique((b.doc.astype(np.uint64) << np.uint64(48)) | (b.word >> np.uint64(16)), return_counts=True))
        hit, self.hit_tf = self._merged(hits, np.int64)
        self.hit_doc, self.hit_term = np.divmod(hit, max(len(asked), 1))
        self.key, self.tf = self._merged(keys, np.uint64)

    @staticmethod
    def _merged(parts, kind):
        if len(parts) == 1:
            return parts[0]
        if not parts:
            return np.zeros(0, kind), np.zeros(0, np.int64)
        key, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        tf = np.zeros(len(key), np.int64)
        np.add.at(tf, at, np.concatenate([p[1] for p in parts]))
        return key, tf

    def impacts(self, doc, tf, norm):
        """The impact of ``tf`` occurrences in a text whose length factor is ``norm``."""
        tf = tf.astype(np.int64)
        return SCALE * tf // (1000 * tf + SATURATION * norm[doc])

    def sketches(self, norm):
        """``(cells, offset, bits)``: the sketches of all texts, one after the other."""
        doc = (self.key >> np.uint64(48)).astype(np.int64)
        distinct = np.bincount(doc, minlength=self.size)
        bits = np.ceil(np.log2(np.maximum(CELLS * distinct, 2))).astype(np.int64)
        offset = np.cumsum(1 << bits) - (1 << bits)
        cell = (self.key & np.uint64((1 << 48) - 1)) >> (np.uint64(48) - bits[doc].astype(np.uint64))
        cells = np.zeros(int((1 << bits).sum()), np.int64)
        np.maximum.at(cells, offset[doc] + cell.astype(np.int64), self.impacts(doc, self.tf, norm))
        return cells, offset, bits


def _blocks(column):
    """``(i, j, folded texts)``: short texts in groups, each long one alone."""
    from vecstack.llm.words import BLOCK_BYTES
    raws, start, size = [], 0, 0
    for i, text in enumerate(column):
        raw = fold(text)
        if raws and (size + len(raw) > BLOCK_BYTES or len(raw) > PIECE):
            yield start, i, raws
            raws, start, size = [], i, 0
        raws.append(raw)
        size += len(raw) + 1
    if raws:
        yield start, start + len(raws), raws


class Batch:
    """Items as arrays: the values of their terms, and for each item the terms with their repeats."""

    def __init__(self, items: list):
        from collections import Counter

        from vecstack.llm.words import Block
        self.ids = np.array([i for i, _ in items], np.int64)
        counted = []
        for _, text in items:
            counted.append(Counter(Block([fold(text)], lower=False).word.tolist()))
        self.values = np.array(sorted({v for c in counted for v in c}), np.uint64)
        self.lists = [(np.searchsorted(self.values, np.array(sorted(c), np.uint64)), np.array([c[v] for v in sorted(c)], np.int64))
                      for c in counted]

    def weigh(self, documents: int, df):
        """Keep the terms that occur, with their weights times their repeats."""
        w = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) if d else 0 for d in df], np.int64)
        use = [(t[df[t] > 0], r[df[t] > 0]) for t, r in self.lists]
        self.term = np.concatenate([t for t, _ in use] or [np.zeros(0, np.int64)])
        self.weight = np.concatenate([r for _, r in use] or [np.zeros(0, np.int64)]) * w[self.term]
        size = np.array([len(t) for t, _ in use], np.int64)
        self.items = np.flatnonzero(size)                          # items with a term that occurs
        self.end = np.cumsum(size)
        self.start = self.end - size


def _batches(items: DataFrame):
    """Items in batches of a bounded number of terms (an item with more is a batch of its own)."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .where("item_id is not null").groupBy("item_id").agg(F.min("text").alias("text")).orderBy("item_id")
    batch, size = [], 0
    for r in rows.toLocalIterator():
        n = len(r["text"]) // 2 + 1
        if batch and size + n > ENTRIES:
            yield Batch(batch)
            batch, size = [], 0
        batch.append((r["item_id"], r["text"]))
        size += n
    if batch:
        yield Batch(batch)


def _statistics(docs: DataFrame, values):
    """``(N, L, df of each asked value)`` over all documents."""
    asked = docs.sparkSession.sparkContext.broadcast(values)

    def run(parts):
        import pandas as pd
        documents = terms = 0
        df = np.zeros(len(asked.value), np.int64)
        for pdf in parts:
            for _, _, raws in _blocks(pdf["text"]):
                c = Counts(raws, asked.value, False)
                documents += int((c.n > 0).sum())
                terms += int(c.n.sum())
                df += np.bincount(c.hit_term, minlength=len(df))
        at = np.flatnonzero(df)
        yield pd.DataFrame({"term": np.append(at, [-1, -2]), "n": np.append(df[at], [documents, terms])})

    got = dict(docs.select("text").mapInPandas(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect())
    return got.get(-1, 0), got.get(-2, 0), np.array([got.get(i, 0) for i in range(len(values))], np.int64)


class _Best:
    """The ``k`` best documents of each item, by score and then by id."""

    def __init__(self, items: int, k: int):
        self.score = np.zeros((items, k), np.int64)
        self.doc = np.full((items, k), np.iinfo(np.int64).max)

    def least(self):
        """The least score that can still matter."""
        return np.maximum(self.score[:, -1], 1)

    def add(self, j, score, doc):
        use = score >= max(int(self.score[j, -1]), 1)
        if use.any():
            s, d = np.append(self.score[j], score[use]), np.append(self.doc[j], doc[use])
            by = np.lexsort((d, -s))[:self.score.shape[1]]
            self.score[j], self.doc[j] = s[by], d[by]


def _scan(c: Counts, batch: Batch, norm, ids, best: _Best):
    """Bounds of a block's documents for all items, then exact scores in their descending order."""
    cells, offset, bits = c.sketches(norm)
    step = max(1, GRID // max(len(batch.term), len(batch.values), 1))
    value = batch.values[batch.term] >> np.uint64(16)
    starts = batch.start[batch.items]
    impact = c.impacts(c.hit_doc, c.hit_tf, norm)
    for i in range(0, c.size, step):
        j = min(c.size, i + step)
        place = (value[None, :] >> (np.uint64(48) - bits[i:j].astype(np.uint64))[:, None]).astype(np.int64)
        place += offset[i:j, None]
        bound = np.add.reduceat(cells[place] * batch.weight, starts, axis=1)
        wanted = bound >= best.least()[batch.items]
        if not wanted.any():
            continue
        lo, hi = np.searchsorted(c.hit_doc, [i, j])
        exact = np.zeros((j - i, len(batch.values)), np.int64)
        exact[c.hit_doc[lo:hi] - i, c.hit_term[lo:hi]] = impact[lo:hi]
        for x in np.flatnonzero(wanted.any(axis=0)):
            item = batch.items[x]
            term, weight = batch.term[batch.start[item]:batch.end[item]], batch.weight[batch.start[item]:batch.end[item]]
            doc = np.flatnonzero(wanted[:, x])
            doc = doc[np.argsort(-bound[doc, x], kind="stable")]
            for s in range(0, len(doc), 16):
                if bound[doc[s], x] < best.least()[item]:
                    break
                some = doc[s:s + 16]
                best.add(item, exact[np.ix_(some, term)] @ weight, ids[i + some])


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of highest score above 0 of each item."""
    spark = docs.sparkSession
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    found = spark.createDataFrame([], SCHEMA)
    for batch in _batches(items):
        documents, terms, df = _statistics(texts, batch.values)
        batch.weigh(documents, df)
        if not len(batch.items):
            continue
        shared = spark.sparkContext.broadcast(batch)

        def run(parts, shared=shared, documents=documents, terms=terms):
            import pandas as pd
            batch = shared.value
            best = _Best(len(batch.ids), k)
            for pdf in parts:
                ids = pdf["doc_id"].to_numpy(np.int64)
                for i, j, raws in _blocks(pdf["text"]):
                    c = Counts(raws, batch.values, True)
                    norm = 100 - LENGTH_PERCENT + np.array([LENGTH_PERCENT * n * documents // terms for n in c.n.tolist()], np.int64)
                    _scan(c, batch, norm, ids[i:j], best)
            x, y = np.nonzero(best.score)
            yield pd.DataFrame({"item_id": batch.ids[x], "doc_id": best.doc[x, y], "score": best.score[x, y]})

        found = found.union(texts.where("doc_id is not null").mapInPandas(run, SCHEMA))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
