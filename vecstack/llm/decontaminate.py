"""Operator 1: benchmark decontamination.

The benchmark items, and their questions and answers as entries of their own, are indexed by BM25
impacts with block maxima over runs of entries.  Impacts are scaled so that an entry matched by all its
words scores 1, or more where the words that 25 % of its shingles can lose weigh so much that a match
would miss the threshold.  Every document is cut into passages (windows of
``2 * S`` words every ``S`` words, ``S`` at least the longest item, so an item never falls between
two).  Every passage is a query; all entries scoring ``THRESHOLD`` or more are retrieved:

* Terms in many entries are non-essential: together they cannot reach the threshold for any entry.  A
  vectorised pass over a block of texts adds up the essential terms and leaves only passages that
  can still reach it.
* For these, block-max WAND walks the posting lists: a pivot whose term maxima, then block maxima,
  sum to less than the threshold is skipped with its whole block.

A retrieved item is contaminating if 75 % of its five-word shingles (question and answer together;
an item of fewer words counts as one) stand in the passage, or 75 % of those inside its question (all
but the last sentence), or of those inside its answer, where that part has ``PART_SHINGLES`` or more.
The score is the item's BM25 share; the overlaps of item, question and answer (here the shingles
reaching into the last sentence) are reported.

The index of one block of items (``ITEM_BYTES`` of text) is broadcast; a larger benchmark is worked
off in several blocks, each against all documents.

Defined results: null or empty texts contain nothing; items with a null id or without words are
ignored; a null ``doc_id`` is carried through; a document row and item give one row, the passage
with the largest overlap (ties: the first).  Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecstack.llm.common import texts

THRESHOLD, OVERLAP, SHINGLE = 0.6, 0.75, 5
K1, B = 1.2, 0.75
ITEM_BYTES = 16 << 20
BLOCK_ITEMS = 16
PART_SHINGLES = 8        # a shorter question or answer says too little by itself
_KEEP = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return text.lower().encode("utf-8", "replace").translate(_KEEP).split()


def answer_start(text: str) -> int:
    """Number of words before the last sentence (0 with a single sentence)."""
    ends = [m.end() for m in re.finditer(r"[.!?]\s+(?=\S)", text)]
    return len(words_of(text[:ends[-1]])) if ends else 0


class _Ids(dict):
    def __missing__(self, word):
        return -1


class Index:
    """BM25 impacts of a block of items, with block maxima; ``df`` and ``n`` are of all items."""

    def __init__(self, items: list[tuple], df: dict, n: int, average: float, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.items = [(i, words_of(t), answer_start(t)) for i, t in items]
        terms = sorted({w for _, ws, _ in self.items for w in ws})
        self.ids = _Ids((w, k) for k, w in enumerate(terms))
        self.stride = max([64] + [len(ws) for _, ws, _ in self.items])
        self.average = max(average, 1e-9)
        self.idf = np.array([math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) for w in terms])
        self.entries = [(x, lo, hi) for x in range(len(self.items)) for lo, hi in self._ranges(x)]
        postings: list[list] = [[] for _ in terms]
        for x, (item, lo, hi) in enumerate(self.entries):
            raw = self._impacts(self.items[item][1][lo:hi])
            whole = sum(raw.values())
            # each shingle that is missing takes one word of the entry at most
            lost = int((1 - OVERLAP) * max(1, hi - lo - SHINGLE + 1))
            left = sum(sorted(raw.values())[:max(1, len(raw) - lost)]) / whole
            scale = max(1.0, threshold / left)
            for t, v in raw.items():
                postings[t].append((x, scale * v / whole))
        self.post_items = [np.array([x for x, _ in p], np.int64) for p in postings]
        self.post_values = [np.array([v for _, v in p]) for p in postings]
        self.term_max = [float(v.max()) for v in self.post_values]
        self.blocks = [{} for _ in postings]              # block of items -> largest impact
        for t, (xs, vs) in enumerate(zip(self.post_items, self.post_values)):
            for x, v in zip((xs // BLOCK_ITEMS).tolist(), vs.tolist()):
                self.blocks[t][x] = max(v, self.blocks[t].get(x, 0.0))
        # non-essential terms: most frequent first, as long as no entry gets half the threshold from them
        self.free = np.zeros(len(self.entries))
        essential = np.ones(len(terms), bool)
        for t in sorted(range(len(terms)), key=lambda t: -len(self.post_items[t])):
            after = self.free.copy()
            after[self.post_items[t]] += self.post_values[t]
            if len(self.post_items[t]) < 2 or after.max() > threshold / 2:
                break
            self.free, essential[t] = after, False
        keep = np.flatnonzero(essential)
        self.essential = np.append(essential, False)      # the last entry is for unknown words
        count = np.array([len(p) for p in self.post_items], np.int64)
        self.at = np.zeros(len(terms), np.int64)
        self.n_of = count
        self.at[keep] = np.cumsum(count[keep]) - count[keep]
        self.flat_items = np.concatenate([self.post_items[t] for t in keep]) if len(keep) else np.zeros(0, np.int64)
        self.flat_values = np.concatenate([self.post_values[t] for t in keep]) if len(keep) else np.zeros(0)
        self.shingles = [self._shingles(ws) for _, ws, _ in self.items]

    def _ranges(self, item: int) -> list[tuple[int, int]]:
        """Word ranges of an item's entries: the whole, the question and the answer if long enough."""
        _, ws, cut = self.items[item]
        least = PART_SHINGLES + SHINGLE - 1
        return [(0, len(ws))] + [(lo, hi) for lo, hi in ((0, cut), (cut, len(ws))) if 0 < cut and hi - lo >= least]

    def _impacts(self, ws) -> dict:
        """BM25 impact of each term id of a word sequence."""
        norm = K1 * (1 - B + B * len(ws) / self.average)
        return {self.ids[w]: float(self.idf[self.ids[w]]) * tf * (K1 + 1) / (tf + norm) for w, tf in Counter(ws).items()}

    def score(self, item: int, terms: set) -> float:
        """BM25 share of a whole item that a set of term ids reaches."""
        raw = self._impacts(self.items[item][1])
        return sum(v for t, v in raw.items() if t in terms) / sum(raw.values())

    @staticmethod
    def _shingles(ws):
        k = min(SHINGLE, len(ws))
        return [tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)] if k else []

    def candidate_passages(self, ids, first, counts):
        """Passages (numbers within the block of texts) that may hold an item, from word ids."""
        s = self.stride
        per_doc = np.maximum(1, -(-counts // s))
        base = np.cumsum(per_doc) - per_doc
        doc = np.repeat(np.arange(len(counts)), counts)
        chunk = base[doc] + (np.arange(len(ids)) - first[doc]) // s
        hit = np.flatnonzero(self.essential[ids])
        n_terms, n_items = len(self.term_max), max(1, len(self.entries))
        chunk, term = chunk[hit], ids[hit].astype(np.int64)
        before = chunk > base[doc[hit]]                   # the passage that began one chunk earlier
        key = np.unique(np.concatenate([chunk, chunk[before] - 1]) * n_terms + np.concatenate([term, term[before]]))
        passage, term = key // n_terms, key % n_terms
        n = self.n_of[term]
        row = np.repeat(np.arange(len(key)), n)
        entry = self.at[term][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        pair, where = np.unique(passage[row] * n_items + self.flat_items[entry], return_inverse=True)
        total = np.bincount(where, self.flat_values[entry], len(pair))
        pair = pair[total + self.free[pair % n_items] >= self.threshold - 1e-9]
        return base, np.unique(pair // n_items)

    def retrieve(self, terms) -> list[tuple[int, float]]:
        """All entries scoring the threshold or more for a set of term ids, by block-max WAND."""
        low = self.threshold - 1e-9
        lists = [[0, self.post_items[t], self.post_values[t], self.term_max[t], self.blocks[t]] for t in terms]
        out = []
        while lists:
            lists.sort(key=lambda c: c[1][c[0]])
            bound, pivot = 0.0, None
            for k, c in enumerate(lists):
                bound += c[3]
                if bound >= low:
                    pivot = k
                    break
            if pivot is None:
                break
            item = int(lists[pivot][1][lists[pivot][0]])
            while pivot + 1 < len(lists) and lists[pivot + 1][1][lists[pivot + 1][0]] == item:
                pivot += 1
            block = item // BLOCK_ITEMS
            if sum(c[4].get(block, 0.0) for c in lists[:pivot + 1]) < low:
                # no item up to the end of the block, or to the next list, can reach the threshold
                target = (block + 1) * BLOCK_ITEMS
                if pivot + 1 < len(lists):
                    target = min(target, int(lists[pivot + 1][1][lists[pivot + 1][0]]))
                target = max(target, item + 1)
            else:
                if lists[0][1][lists[0][0]] == item:
                    score = sum(float(c[2][c[0]]) for c in lists[:pivot + 1])
                    if score >= low:
                        out.append((item, score))
                    target = item + 1
                else:
                    target = item
            for c in lists[:pivot + 1]:
                c[0] += int(np.searchsorted(c[1][c[0]:], target))
            lists = [c for c in lists if c[0] < len(c[1])]
        return out

    def overlaps(self, item: int, passage: list[bytes]) -> tuple[bool, tuple[float, float, float]]:
        """Whether the passage leaks the item, and the shares of the item's shingles in the passage: all,
        question, answer (1 for an empty part)."""
        _, ws, cut = self.items[item]
        k = min(SHINGLE, len(ws))
        have = {tuple(passage[i:i + k]) for i in range(len(passage) - k + 1)}
        found = [s in have for s in self.shingles[item]]
        ask = [f for i, f in enumerate(found) if i + k <= cut]
        reply = found[len(ask):]
        share = lambda x: sum(x) / len(x) if x else 1.0
        parts = [found[lo:hi - SHINGLE + 1] for lo, hi in self._ranges(item)[1:]]
        leak = share(found) >= OVERLAP or any(share(x) >= OVERLAP for x in parts)
        return leak, (share(found), share(ask), share(reply))

    def search(self, column) -> list[tuple]:
        """``(row, item id, score, overlap, question, answer)`` of a list of texts."""
        out = []
        step = 500
        for at in range(0, len(column), step):
            lists = [words_of(t) for t in column[at:at + step]]
            counts = np.array([len(ws) for ws in lists], np.int64)
            first = np.cumsum(counts) - counts
            ids = np.fromiter((i for ws in lists for i in map(self.ids.__getitem__, ws)), np.int32, int(counts.sum()))
            base, passages = self.candidate_passages(ids, first, counts)
            best: dict = {}
            for p in passages.tolist():
                d = int(np.searchsorted(base, p, side="right")) - 1
                lo = (p - int(base[d])) * self.stride
                ws = lists[d][lo:lo + 2 * self.stride]
                terms = set(map(self.ids.__getitem__, ws)) - {-1}
                for item in sorted({self.entries[x][0] for x, _ in self.retrieve(sorted(terms))}):
                    leak, found = self.overlaps(item, ws)
                    if leak and found[0] > best.get((d, item), (0, -1.0))[1]:
                        best[d, item] = (self.score(item, terms), *found)
            out += [(at + d, self.items[item][0], *v) for (d, item), v in best.items()]
        return out


def index_blocks(items: DataFrame, threshold: float = THRESHOLD, item_bytes: int = ITEM_BYTES):
    """Broadcast indexes of the items, as many blocks as their text needs."""
    spark = items.sparkSession
    items = items.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()

    def count(parts):
        import pandas as pd
        for pdf in parts:
            lists = [words_of(t) for t in pdf["text"]]
            yield pd.DataFrame({"word": [w for ws in lists for w in set(ws)] + [b""] * len(lists),
                                "n": [0] * sum(len(set(ws)) for ws in lists) + [len(ws) for ws in lists]})

    stats = items.select("text").mapInPandas(count, "word binary, n bigint").groupBy("word").agg(
        F.count("*").alias("df"), F.sum("n").alias("n"))
    total = stats.where(F.length("word") == 0).first()
    if total is None or not total["n"]:
        return []
    size = items.agg(F.sum(F.octet_length("text"))).first()[0]
    n_blocks = max(1, -(-size // item_bytes))
    out = []
    for b in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b).orderBy("item_id", "text").collect()
        chosen = [(r["item_id"], r["text"]) for r in rows if words_of(r["text"])]
        if not chosen:
            continue
        own = {w for _, t in chosen for w in words_of(t)}
        frame = spark.createDataFrame([(bytearray(w),) for w in sorted(own)], "word binary") if n_blocks > 1 else None
        df = stats if frame is None else stats.join(frame, "word", "left_semi")
        known = {bytes(r["word"]): r["df"] for r in df.where(F.length("word") > 0).collect()}
        out.append(spark.sparkContext.broadcast(Index(chosen, known, total["df"], total["n"] / total["df"], threshold)))
    return out


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``(doc_id, item_id, score, overlap, question_overlap, answer_overlap)`` of every leak."""
    schema = "doc_id bigint, item_id bigint, score double, overlap double, question_overlap double, answer_overlap double"
    docs = texts(docs)
    found = docs.sparkSession.createDataFrame([], schema)

    def against(shared):
        def run(parts):
            import pandas as pd
            for pdf in parts:
                hits = shared.value.search(pdf["text"].tolist())
                if hits:
                    rows, *cols = zip(*hits)
                    yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[list(rows)].to_numpy(), **dict(zip(
                        ["item_id", "score", "overlap", "question_overlap", "answer_overlap"], map(list, cols)))})
        return docs.mapInPandas(run, schema)

    for shared in index_blocks(items, threshold, item_bytes):
        found = found.union(against(shared))
    return found


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item; nothing is shuffled."""
    for shared in index_blocks(items, threshold):
        @F.pandas_udf("boolean")
        def leaks(text, shared=shared):
            import pandas as pd
            hits = {h[0] for h in shared.value.search(text.fillna("").tolist())}
            return pd.Series([i in hits for i in range(len(text))])
        docs = docs.where(~leaks(docs["text"].cast("string")))
    return docs
