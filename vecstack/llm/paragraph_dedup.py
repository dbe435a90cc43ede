"""Operator 2: substring dedup over paragraphs by MinHash banding.

Two kinds of units are looked for.  *Lines*: newline-split lines of at least ``MIN_WORDS`` words.  *Windows*: ``WINDOW``
words from each anchor on, whatever the newlines; an anchor is a word whose hash is the smallest among the
``REACH`` words on either side, so a passage has the same anchors wherever it stands, inside longer lines or
across lines (a passage of 50 words nearly always holds a whole window).

Identical lines collapse first; each distinct one gets ``BANDS`` bands of ``ROWS`` minima over its five-word shingles (at a
Jaccard similarity of 0.75 a pair shares a band with probability 1 - (1 - 0.75^4)^16 > 0.997).  Lines that collide in a
band are verified by their whole shingle sets and clustered by connected components.  A first round verifies every line
against the first one of each of its buckets.  Buckets that still hold several components are compared whole, each distinct
set of lines once, in a task that emits only links that join components (one product of 0/1 matrices over the shingles
that several of the lines have); large buckets are cut into blocks, and all pairs of blocks meet.
Windows cluster by identity: near copies are a matter of the lines.

All occurrences but the first of a cluster are removals.  The units of a document that touch or overlap are one span.

Defined results: null and empty texts have no units; rows with a null ``doc_id`` are left out;
repeated rows are repeated occurrences; ties go to the smallest ``(doc_id, place)``.  Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecstack.llm.common import components, cut_lineage, materialise, texts, with_membership
from vecstack.llm.sets import group_links

MIN_WORDS, SHINGLE, BANDS, ROWS, NUM, DEN = 25, 5, 16, 4, 75, 100
WINDOW, REACH = 25, 5
GROUP = 4000           # lines of one block in a comparison of a bucket
_SEEDS = np.random.default_rng(7).integers(1, 1 << 63, (BANDS * ROWS, 2), dtype=np.uint64) | np.uint64(1)


class _Paragraphs:
    """The paragraphs of a block of texts, as arrays: ``doc``, ``line``, ``start`` (word of the text), ``words`` (their number),
    ``pid`` (64-bit value of the word sequence); shingle ``k``-runs ``grams[at[p]:at[p + 1]]``."""

    def __init__(self, raw: list[bytes], min_words: int, k: int = SHINGLE):
        from vecstack.llm.words import Block, mix
        b = Block(raw)
        start, end, doc = b.lines()
        first = np.searchsorted(b.start, start)
        count = np.searchsorted(b.start, end) - first
        line = np.arange(len(start)) - np.searchsorted(doc, np.arange(b.n))[doc]
        use = np.flatnonzero(count >= max(k, min_words))
        self.doc, self.line, self.words, first = doc[use], line[use], count[use], first[use]
        self.start = first - b.first[self.doc]
        inside, at = self._runs(first, self.words)
        place = np.arange(len(inside)) - np.repeat(at, self.words)
        spread = mix(b.word[inside] + mix(place.astype(np.uint64) + np.uint64(1)))
        self.pid = mix(np.add.reduceat(spread, at) if len(use) else np.zeros(0, np.uint64)).view(np.int64)
        inside, at = self._runs(first, self.words - k + 1)
        self.grams = b.grams(k)[0][inside]
        self.at = np.append(at, len(inside))

    @staticmethod
    def _runs(first, n):
        """Indices of the runs ``first[i]..first[i] + n[i]`` one after the other, and their offsets."""
        at = np.cumsum(n) - n
        return np.repeat(first - at, n) + np.arange(int(n.sum())), at

    def bands(self):
        """``BANDS`` 64-bit values of each paragraph from the minima of its rows."""
        from vecstack.llm.words import mix
        out = np.empty((len(self.pid), BANDS), np.uint64)
        for band in range(BANDS if len(self.pid) else 0):
            h = np.uint64(band)
            for a, c in _SEEDS[band * ROWS:(band + 1) * ROWS]:
                x = self.grams * a + c
                x ^= x >> np.uint64(32)
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) ^ np.minimum.reduceat(x, self.at[:-1]))
            out[:, band] = h
        return out.view(np.int64)

    def shingles(self, p: int):
        return np.unique(self.grams[self.at[p]:self.at[p + 1]])


def paragraphs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, paragraph, start, n_words, pid, bands)`` of every paragraph."""
    def run(parts):
        import pandas as pd

        from vecstack.llm.words import blocks, encode
        for pdf in parts:
            raw, ids = encode(pdf["text"]), pdf["doc_id"].to_numpy()
            for i, j in blocks(raw):
                p = _Paragraphs(raw[i:j], min_words)
                if not len(p.pid):
                    continue
                yield pd.DataFrame({"doc_id": ids[i:j][p.doc], "paragraph": p.line, "start": p.start, "n_words": p.words, "pid": p.pid, "bands": list(p.bands())})

    return docs.mapInPandas(run, "doc_id bigint, paragraph int, start int, n_words int, pid bigint, bands array<bigint>")


def _verified(pairs: DataFrame, docs: DataFrame, first: DataFrame, min_words: int) -> DataFrame:
    """The pairs ``(a, b)`` of paragraph ids with a Jaccard similarity of 75 % or more."""
    pairs = cut_lineage(pairs.distinct())
    sets = _sets_of(pairs.select(F.col("a").alias("pid")).union(pairs.select("b")).distinct(), docs, first, min_words)
    a, b = (sets.select(F.col("pid").alias(c), F.col("items").alias("i" + c)) for c in "ab")
    got = pairs.join(a, "a").join(b, "b").select("a", "b", F.size("ia").alias("na"), F.size("ib").alias("nb"),
                                                 F.size(F.array_intersect("ia", "ib")).alias("i"))
    return got.where(f"{DEN} * i >= {NUM} * (na + nb - i)").select("a", "b")


def _sets_of(pids: DataFrame, docs: DataFrame, first: DataFrame, min_words: int) -> DataFrame:
    """``(pid, items)``: the shingles of the paragraphs ``pids(pid)``."""
    wanted = pids.join(first, "pid")
    places = cut_lineage(wanted.groupBy("doc_id").agg(F.collect_list("paragraph").alias("lines")))

    def run(parts):
        import pandas as pd

        from vecstack.llm.words import blocks, encode
        for pdf in parts:
            raw, lines = encode(pdf["text"]), [set(map(int, x)) for x in pdf["lines"]]
            for i, j in blocks(raw):
                p = _Paragraphs(raw[i:j], min_words)
                rows = [x for x in range(len(p.pid)) if int(p.line[x]) in lines[i + p.doc[x]]]
                if rows:
                    yield pd.DataFrame({"pid": p.pid[rows], "items": [p.shingles(x).view(np.int64) for x in rows]})

    asked = with_membership(docs, "doc_id", places, "doc_id").where("__listed").drop("__listed")
    return materialise(asked.join(places, "doc_id").select("text", "lines").mapInPandas(run, "pid bigint, items array<bigint>")
                       .dropDuplicates(["pid"]))


def _bucket_links(rest: DataFrame, docs: DataFrame, first: DataFrame, min_words: int) -> DataFrame:
    """Links ``(a, b)`` between the components of each bucket of ``rest(key, pid, comp)``, all its lines compared."""
    groups = rest.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("pid").cast("decimal(38,0)")).alias("s"),
                                     F.sum(F.xxhash64("pid", F.lit(1)).cast("decimal(38,0)")).alias("t"))
    groups = cut_lineage(groups.groupBy("n", "s", "t").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("n") / GROUP).cast("int").alias("parts")))
    member = cut_lineage(rest.join(groups, "key"))
    sets = _sets_of(member.select("pid").distinct(), docs, first, min_words)
    own = F.pmod(F.xxhash64("pid"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    member = member.withColumn("own", own).withColumn("with", other)
    member = member.select("key", "pid", "comp", "own", F.least("own", "with").alias("x"), F.greatest("own", "with").alias("y"))

    def run(parts):
        yield from group_links(parts, ["key", "x", "y"], "pid", NUM, DEN)

    met = member.join(sets, "pid").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return met.mapInPandas(run, "a bigint, b bigint").distinct()


def repeated_paragraphs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, paragraph, start, n_words, cluster, component_id, n_copies, removed)`` of every paragraph
    that occurs again, exactly or nearly; ``component_id`` is the smallest document of the cluster."""
    docs = texts(docs).where("doc_id is not null")
    found = materialise(paragraphs(docs, min_words))
    places = found.select("doc_id", "paragraph", "start", "n_words", "pid")
    distinct = found.groupBy("pid").agg(F.first("bands").alias("bands"))
    keys = materialise(distinct.select("pid", F.explode("bands").alias("key")))
    first = places.groupBy("pid").agg(F.min(F.struct("doc_id", "paragraph")).alias("at")).select("pid", "at.*")
    shared = keys.groupBy("key").agg(F.min("pid").alias("lead"), F.max("pid").alias("high")).where("lead < high").select("key", "lead")
    keys = materialise(keys.join(shared, "key"))
    tried = keys.where("pid <> lead").select(F.col("lead").alias("a"), F.col("pid").alias("b"))
    links = cut_lineage(_verified(tried, docs, first, min_words))
    comp = cut_lineage(components(links).withColumnRenamed("node", "pid"))
    # pairs of one bucket in different components, not yet compared
    rest = keys.join(comp, "pid", "left").select("key", "lead", "pid", F.coalesce("component", "pid").alias("comp"))
    open_ = rest.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    rest = cut_lineage(rest.join(open_, "key", "left_semi").select("key", "pid", "comp"))
    star = comp.where("pid <> component").select(F.col("pid").alias("a"), F.col("component").alias("b"))
    final = components(star.union(_bucket_links(rest, docs, first, min_words))).withColumnRenamed("node", "pid")
    placed = places.join(final, "pid", "left").select("doc_id", "paragraph", "start", "n_words", F.coalesce("component", "pid").alias("cluster"))
    heads = placed.groupBy("cluster").agg(F.count("*").alias("n_copies"), F.min(F.struct("doc_id", "paragraph")).alias("head")) \
        .where("n_copies > 1")
    return placed.join(heads, "cluster").select(
        "doc_id", "paragraph", "start", "n_words", "cluster", F.col("head.doc_id").alias("component_id"), "n_copies",
        (F.struct("doc_id", "paragraph") != F.col("head")).alias("removed"))


# ------------------------------------------------------------------ windows and spans
_SLOTS = 21            # log2 of the words whose hashes a worker keeps (32 MB)
_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))
_KEPT: list = []


def _word_hashes(b):
    """32 bits of the MD5 of every (lower-cased) word of a block; words seen before are looked up by their value."""
    if not _KEPT:
        _KEPT.extend([np.full(1 << _SLOTS, (1 << 64) - 1, np.uint64), np.zeros(1 << _SLOTS, np.int64)])
    values, hashes = _KEPT
    slot = (b.word >> np.uint64(64 - _SLOTS)).astype(np.int64)
    out = hashes[slot]
    miss = np.flatnonzero(values[slot] != b.word)
    if len(miss):
        raw = b.raw.tobytes()
        new, first, at = np.unique(b.word[miss], return_index=True, return_inverse=True)
        words = [raw[s:e].translate(_LOWER) for s, e in zip(b.start[miss[first]].tolist(), b.end[miss[first]].tolist())]
        found = np.array([int(hashlib.md5(w).hexdigest()[:8], 16) for w in words], np.int64)
        out[miss] = found[at]
        slot = (new >> np.uint64(64 - _SLOTS)).astype(np.int64)
        values[slot], hashes[slot] = new, found
    return out


def _anchors(b):
    """Words whose hash is below those of the ``REACH`` words before and not above those of the ``REACH`` words after, in
    their text, and that have a whole window."""
    h, n = _word_hashes(b), len(b.word)
    keep = np.arange(n) + WINDOW <= b.first[b.doc + 1]
    for o in range(1, REACH + 1):
        same = b.doc[o:] == b.doc[:-o]
        keep[o:] &= ~same | (h[o:] < h[:-o])
        keep[:-o] &= ~same | (h[:-o] <= h[o:])
    return np.flatnonzero(keep)


def windows(docs: DataFrame) -> DataFrame:
    """``(doc_id, start, a, b)``: the windows of every text with two 64-bit values of their words."""
    def run(parts):
        import pandas as pd

        from vecstack.llm.words import Block, blocks, encode, mix
        place = np.arange(WINDOW, dtype=np.uint64)
        for pdf in parts:
            raw, ids = encode(pdf["text"]), pdf["doc_id"].to_numpy()
            for i, j in blocks(raw):
                b = Block(raw[i:j])
                at = _anchors(b)
                words = b.word[at[:, None] + np.arange(WINDOW)]
                value = lambda salt: mix((mix(words + mix(place * np.uint64(2) + np.uint64(salt)))).sum(axis=1, dtype=np.uint64)).view(np.int64)
                yield pd.DataFrame({"doc_id": ids[i:j][b.doc[at]], "start": at - b.first[b.doc[at]], "a": value(1), "b": value(1 << 32)})

    return docs.mapInPandas(run, "doc_id bigint, start int, a bigint, b bigint")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``(doc_id, start, n_words, component_id, removed)`` of every window that occurs again."""
    found = materialise(windows(texts(docs).where("doc_id is not null")))
    again = found.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "start")).alias("head")).where("n > 1")
    again = materialise(again.select("a", "b", F.col("head.doc_id").alias("component_id"), F.col("head.start").alias("head_start")))
    maybe = with_membership(found, "a", again, "a").where("__listed").drop("__listed")
    return maybe.join(again, ["a", "b"]).select("doc_id", "start", F.lit(WINDOW).alias("n_words"), "component_id",
                                               ((F.col("doc_id") != F.col("component_id")) | (F.col("start") != F.col("head_start"))).alias("removed"))


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, first_word, n_words, n_units, component_id, n_removed)`` of every maximal span of repeated units.

    ``component_id``: the smallest document of the clusters of its units; ``n_removed``: its words in units that
    are not the first of their cluster."""
    columns = ("doc_id", "start", "n_words", "component_id", "removed")
    units = repeated_paragraphs(docs, min_words).select(*columns).union(repeated_windows(docs).select(*columns))
    units = units.withColumn("end", F.col("start") + F.col("n_words"))
    order = Window.partitionBy("doc_id").orderBy("start", "end", "removed")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    removed_end = F.coalesce(F.max(F.when(F.col("removed"), F.col("end"))).over(before), F.lit(0))
    units = units.withColumn("fresh", F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int")) \
        .withColumn("cut", F.when(F.col("removed"), F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), removed_end))).otherwise(0))
    units = units.withColumn("span", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return units.groupBy("doc_id", "span").agg(F.min("start").alias("first_word"), F.max("end").alias("end"), F.count("*").alias("n_units"),
                                               F.min("component_id").alias("component_id"), F.sum("cut").alias("n_removed")) \
        .select("doc_id", "first_word", (F.col("end") - F.col("first_word")).alias("n_words"), "n_units", "component_id", F.col("n_removed").cast("bigint").alias("n_removed"))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, text)`` with every removal cut out (its line goes)."""
    gone = repeated_paragraphs(docs, min_words).where("removed").groupBy("doc_id").agg(F.collect_set("paragraph").alias("gone"))
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.array_contains(F.col("gone"), i))
    return texts(docs).join(gone, "doc_id", "left").select(
        "doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))
