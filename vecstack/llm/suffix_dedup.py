"""Operator 8: exact substring dedup with suffix arrays built by the difference-cover method.

Every byte covered by a ``LENGTH``-byte string that starts anywhere else as well is removed.

Distribution.  Each window of ``LENGTH`` bytes is assigned to its *anchor*, the leftmost k-gram of
least hash inside it; equal windows have equal anchors at the same offset.  Consecutive windows with
one anchor form a *context*, so a text is a chain of contexts.  Only anchors found twice matter (the
rest cannot hold a repeated window).  Contexts that occur twice as a whole are repeated throughout;
the others are shuffled by anchor and compared in each task.

Comparison.  In a task the contexts of complete anchors are concatenated and their suffixes sorted by
the difference-cover algorithm: the suffixes at positions 1 and 2 modulo 3 are named by sorting their
triples, recursing on the names while they are not unique; the remaining suffixes are sorted by first
symbol and the rank behind it, and merged.  Neighbours whose first ``LENGTH`` bytes agree are
repeated.  The contexts of an anchor with more than ``LARGE_GROUP`` different ones (a passage in a
large share of all documents) are compared window by window with 128-bit fingerprints and a grouped
count instead, so no task holds them all.

Defined results: a null text is the empty text; texts shorter than ``LENGTH`` bytes lose nothing; a
null ``doc_id`` is carried through; repeated rows repeat each other; every row gives one row.  Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecstack.llm.common import cut_lineage, materialise, texts, with_membership

LENGTH, GRAM = 400, 200
SEGMENT = 1 << 20          # bytes of one text handled at once
LARGE_GROUP = 2000
BATCH_BYTES = 1 << 20      # of contexts sorted together
_POSITION = np.uint64((1 << 22) - 1)


# ------------------------------------------------------------------ difference-cover suffix sort
def suffix_array(s):
    """Suffix order of an array of positive integers, by the difference cover {1, 2} modulo 3."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([s.astype(np.int64), np.zeros(3, np.int64)])
    sample = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])
    top = int(t.max()) + 1
    if top < 1 << 21:
        _, name = np.unique((t[sample] * top + t[sample + 1]) * top + t[sample + 2], return_inverse=True)
    else:
        _, pair = np.unique(t[sample] * top + t[sample + 1], return_inverse=True)
        _, name = np.unique(pair * top + t[sample + 2], return_inverse=True)
    order = np.empty(len(sample), np.int64)
    if name.max() + 1 < len(sample):
        order = suffix_array(name + 1)
    else:
        order[name] = np.arange(len(sample))
    ranked = sample[order]                            # sampled suffixes in order
    rank = np.zeros(n + 3, np.int64)
    rank[ranked] = np.arange(1, len(ranked) + 1)
    ranked = ranked[ranked < n]
    rest = np.arange(0, n, 3)
    key = t[rest] << 32 | rank[rest + 1]
    by = np.argsort(key, kind="stable")
    rest, key = rest[by], key[by]
    one, two = ranked[ranked % 3 == 1], ranked[ranked % 3 == 2]
    before = np.searchsorted(t[one] << 32 | rank[one + 1], key)
    pairs = lambda i: t[i] * top + t[i + 1]
    _, code = np.unique(np.concatenate([pairs(two), pairs(rest)]), return_inverse=True)
    before = before + np.searchsorted(code[:len(two)].astype(np.int64) << 32 | rank[two + 2], code[len(two):].astype(np.int64) << 32 | rank[rest + 2])
    out = np.full(n, -1, np.int64)
    out[before + np.arange(len(rest))] = rest
    out[out < 0] = ranked
    return out


def repeated_starts(pieces: list[bytes], length: int = LENGTH):
    """For each piece, the sorted starts of ``length``-byte strings that occur at least twice."""
    joined = np.concatenate([np.concatenate([np.frombuffer(p, np.uint8).astype(np.int64) + 2, [1]]) for p in pieces])
    size = np.array([len(p) + 1 for p in pieces])
    at = np.cumsum(size) - size
    starts = np.concatenate([np.arange(a, a + n - length) for a, n in zip(at, size)])     # whole strings only
    whole = np.zeros(len(joined), bool)
    whole[starts] = True
    order = suffix_array(joined)
    order = order[whole[order]]                       # equal strings stay next to each other
    text = (joined - 2).astype(np.uint8)              # a whole string holds no separator
    view = np.lib.stride_tricks.sliding_window_view(text, length)
    same = np.zeros(max(0, len(order) - 1), bool)
    for i in range(0, len(same), 4096):
        a, b = order[i:i + 4096], order[i + 1:i + 4097]
        a = a[:len(b)]
        like = np.flatnonzero((text[a] == text[b]) & (text[a + length - 1] == text[b + length - 1]) & (text[a + length // 2] == text[b + length // 2]))
        same[i + like] = (view[a[like]] == view[b[like]]).all(axis=1)
    again = np.zeros(len(joined), bool)
    again[order[:-1][same]] = True
    again[order[1:][same]] = True
    return [np.flatnonzero(again[a:a + n]) for a, n in zip(at, size)]


# ------------------------------------------------------------------ anchors and contexts
def _sliding_min(x, w):
    n = len(x) - w + 1
    pad = -len(x) % w
    a = np.concatenate([x, np.full(pad, ~np.uint64(0))]).reshape(-1, w)
    ahead = np.minimum.accumulate(a, axis=1).ravel()
    back = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def contexts_of(data: bytes):
    """``(anchor, first, last, same)`` of the contexts of a text: its windows start at
    ``first..last``; ``same`` is equal for contexts of equal bytes."""
    from vecstack.llm.words import Block
    out = []
    for base in range(0, max(1, len(data) - LENGTH + 1), SEGMENT):
        part = data[base:base + SEGMENT + LENGTH - 1]
        if len(part) < LENGTH:
            break
        b = Block([part], lower=False)
        p = np.arange(len(part) - GRAM + 1)
        h = b.value(p, p + GRAM)
        least = _sliding_min(h & ~_POSITION | p.astype(np.uint64), LENGTH - GRAM + 1)
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        first = np.concatenate([[0], cut])
        last = np.concatenate([cut, [len(least)]]) - 1
        anchor = (least[first] & _POSITION).astype(np.int64)
        out.append((h[anchor].view(np.int64), first + base, last + base, b.value(first, last + LENGTH).view(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out))


def _rows(docs: DataFrame) -> DataFrame:
    """Input rows with a key that is equal for equal rows only."""
    return texts(docs).withColumn("row", F.xxhash64("doc_id", "text"))


def _contexts(rows: DataFrame) -> DataFrame:
    def run(parts):
        import pandas as pd

        from vecstack.llm.words import encode
        for pdf in parts:
            got = [contexts_of(b) for b in encode(pdf["text"])]
            n = [len(g[0]) for g in got]
            if sum(n):
                yield pd.DataFrame({"row": np.repeat(pdf["row"].to_numpy(), n), **{
                    c: np.concatenate([g[k] for g in got]) for k, c in enumerate(["anchor", "first", "last", "same"])}})

    return rows.select("row", "text").mapInPandas(run, "row bigint, anchor bigint, first bigint, last bigint, same bigint")


def _cut(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted contexts: ``(row, anchor, kinds, first, piece)``."""
    def run(parts):
        import pandas as pd

        from vecstack.llm.words import encode
        for pdf in parts:
            out = []
            for r, b, list_ in zip(pdf["row"].tolist(), encode(pdf["text"]), pdf["wanted"]):
                out += [(r, w["anchor"], w["kinds"], w["first"], b[w["first"]:w["last"] + LENGTH]) for w in list_]
                if len(out) >= 5000:
                    yield pd.DataFrame(out, columns=["row", "anchor", "kinds", "first", "piece"])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=["row", "anchor", "kinds", "first", "piece"])

    by_row = cut_lineage(wanted.groupBy("row").agg(F.collect_list(F.struct("anchor", "kinds", "first", "last")).alias("wanted")))
    asked = with_membership(rows, "row", by_row, "row").where("__listed")
    # of equal rows one is enough: their contexts occur twice as a whole
    return asked.select("row", "text").join(by_row, "row").mapInPandas(
        run, "row bigint, anchor bigint, kinds bigint, first bigint, piece binary")


def _compare(pieces: DataFrame) -> DataFrame:
    """Repeated windows among the (different) pieces of each anchor: ``(row, lo, hi)`` byte ranges."""
    schema = "row bigint, lo bigint, hi bigint"

    def emit(batch):
        import pandas as pd
        rows, firsts, data = zip(*batch)
        out = []
        for r, f, starts in zip(rows, firsts, repeated_starts(list(data))):
            if len(starts):
                cut = np.flatnonzero(np.diff(starts) > 1) + 1
                out += [(r, f + int(x[0]), f + int(x[-1]) + LENGTH) for x in np.split(starts, cut)]
        return pd.DataFrame(out, columns=["row", "lo", "hi"])

    def run(parts):
        batch, size, now = [], 0, None
        for pdf in parts:
            for r, a, f, piece in zip(pdf["row"].tolist(), pdf["anchor"].tolist(), pdf["first"].tolist(), pdf["piece"]):
                if a != now and size >= BATCH_BYTES:
                    yield emit(batch)
                    batch, size = [], 0
                now = a
                batch.append((r, f, piece))
                size += len(piece)
        if batch:
            yield emit(batch)

    return pieces.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(run, schema)


def _compare_large(pieces: DataFrame) -> DataFrame:
    """The same for anchors with very many pieces: fingerprints of every window, grouped."""
    def run(parts):
        import pandas as pd

        from vecstack.llm.words import Block, mix
        half = LENGTH // 2
        for pdf in parts:
            for i in range(0, len(pdf), 1000):
                part = pdf.iloc[i:i + 1000]
                b = Block(list(part["piece"]), lower=False)
                n = np.maximum(b.sizes - LENGTH + 1, 0)
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)         # start within its piece
                p = np.repeat(b.offset[:-1], n) + inside
                x, y = b.value(p, p + half), b.value(p + half, p + LENGTH)
                yield pd.DataFrame({"row": np.repeat(part["row"].to_numpy(), n), "lo": np.repeat(part["first"].to_numpy(), n) + inside,
                                    "x": mix(x * np.uint64(3) + y).view(np.int64), "y": mix(y * np.uint64(5) ^ x).view(np.int64)})

    windows = pieces.mapInPandas(run, "row bigint, lo bigint, x bigint, y bigint")
    again = windows.groupBy("x", "y").agg(F.count("*").alias("n")).where("n > 1").select("x", "y")
    return windows.join(again, ["x", "y"]).select("row", "lo", (F.col("lo") + LENGTH).alias("hi"))


def repeated_ranges(rows: DataFrame) -> DataFrame:
    """``(row, lo, hi)``: byte ranges made of repeated windows (they may overlap)."""
    contexts = materialise(_contexts(rows))
    shared = contexts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    contexts = materialise(contexts.join(shared, "anchor"))
    copies = materialise(contexts.groupBy("anchor", "same").agg(F.count("*").alias("n"), F.min(F.struct("row", "first", "last")).alias("at")))
    whole = contexts.join(copies.where("n > 1").select("anchor", "same"), ["anchor", "same"], "left_semi").select(
        "row", F.col("first").alias("lo"), (F.col("last") + LENGTH).alias("hi"))
    # anchors with a context that occurs once, next to other contexts
    kinds = copies.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("least = 1 and kinds > 1")
    pieces = materialise(_cut(rows, copies.join(kinds.select("anchor", "kinds"), "anchor").select("anchor", "kinds", "at.*")))
    large = F.col("kinds") > LARGE_GROUP
    return whole.union(_compare(pieces.where(~large).drop("kinds"))).union(_compare_large(pieces.where(large).drop("kinds")))


def deduplicate(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept BINARY)`` of every row: the maximal removed runs (byte
    offsets, end exclusive) and the bytes that are left."""
    rows = _rows(docs)
    ranges = materialise(repeated_ranges(rows).distinct())
    by_row = cut_lineage(ranges.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")))
    marked = with_membership(rows, "row", by_row, "row")

    def run(parts):
        import pandas as pd

        from vecstack.llm.words import encode
        for pdf in parts:
            for i in range(0, len(pdf), 1000):
                part = pdf.iloc[i:i + 1000]
                spans, kept, size = [], [], []
                for b, ranges in zip(encode(part["text"]), part["ranges"]):
                    runs: list[list[int]] = []
                    for lo, hi in sorted((x["lo"], x["hi"]) for x in (ranges if ranges is not None else ())):
                        if runs and lo <= runs[-1][1]:
                            runs[-1][1] = max(hi, runs[-1][1])
                        else:
                            runs.append([lo, hi])
                    edges = [0, *[x for r in runs for x in r], len(b)]
                    kept.append(b"".join(b[x:y] for x, y in zip(edges[::2], edges[1::2])))
                    spans.append([{"start": x, "end": y} for x, y in runs])
                    size.append(len(b))
                yield pd.DataFrame({"doc_id": part["doc_id"], "n_bytes": size, "spans": spans, "kept": kept})

    # rows without a repeated string keep their bytes and are not shuffled
    untouched = marked.where("not __listed").withColumn("ranges", F.lit(None).cast(by_row.schema["ranges"].dataType))
    joined = marked.where("__listed").join(by_row, "row", "left")
    return joined.select("doc_id", "text", "ranges").union(untouched.select("doc_id", "text", "ranges")).mapInPandas(
        run, "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")


def report(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return deduplicate(docs).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                                    F.sha2("kept", 256).alias("kept_sha256"))
