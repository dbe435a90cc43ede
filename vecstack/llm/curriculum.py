"""Operator 13: mixing sources to target weights as a time-varying curriculum.

Each source has a weight schedule over training time ``t`` in [0, 1] (straight lines between knots).  The
integral of its schedule is its weight: the weights share ``share`` times all words, a target stops at ``cap`` times
its source's words, and the excess is shared again by weight until no target is above (whole-number sums, so
reruns agree).  The source's documents in hash order, repeated up to ``cap`` times, are a stream of words; its first ``target``
words are taken.  A word at fraction ``x`` of the target stands where the integral of the schedule reaches
``x`` times its whole: that inverse of the cumulative demand is the position of a document in training,
and documents are range-sorted by it.

Hash order comes from MD5 (document id and text), cut into ranges of equal hash width; running sums inside a range plus
the sums of the ranges before it give each document's place, so a source with a third of all rows is spread over
all tasks.  The number of ranges grows with the square root of the rows, which keeps ranges
and the lists of their sums small alike.  Everything runs in built-in functions.

Defined results: a null or empty text has size 0, is never taken and has no position; null is a source of its own, after
all others; a null ``doc_id`` is a document as any other; repeated rows are documents of their own (equal rows
are interchangeable); extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecstack.llm.common import cut_lineage, materialise

SEED, CAP = "curriculum", 3
HASH_DIGITS = 15           # hexadecimal digits of the hash order


@dataclass(frozen=True)
class Schedule:
    """A weight over training time: straight lines between ``(time, weight)`` knots from 0 to 1."""

    knots: tuple

    def __post_init__(self):
        t = [x for x, _ in self.knots]
        if t[0] != 0 or t[-1] != 1 or any(a >= b for a, b in zip(t, t[1:])) or any(w < 0 for _, w in self.knots):
            raise ValueError("knots run from time 0 to 1 with weights of at least 0")

    @cached_property
    def pieces(self) -> list:
        """``(start, length, weight, slope, integral before)`` of each straight line, exactly."""
        out, before = [], Fraction(0)
        for (t, w), (u, v) in zip(self.knots, self.knots[1:]):
            t, w, u, v = (Fraction(str(x)) for x in (t, w, u, v))
            out.append((t, u - t, w, (v - w) / (u - t), before))
            before += (u - t) * (w + v) / 2
        return out

    @cached_property
    def weight(self) -> Fraction:
        _, length, w, slope, before = self.pieces[-1]
        return before + length * (w + slope * length / 2)

    def position(self, x: Column) -> Column:
        """The time at which the integral reaches the fraction ``x`` of the whole."""
        need = x * F.lit(float(self.weight))
        found = None
        for t, _, w, slope, before in reversed(self.pieces):
            y = need - F.lit(float(before))
            root = F.sqrt(F.greatest(F.lit(0.0), F.lit(float(w * w)) + F.lit(float(2 * slope)) * y))
            at = F.when(y <= 0, F.lit(float(t))).otherwise(F.lit(float(t)) + 2 * y / (F.lit(float(w)) + root))
            found = at if found is None else F.when(need < F.lit(float(last)), at).otherwise(found)
            last = before
        return F.least(found, F.lit(1.0))

    def demand(self, t: Column) -> Column:
        """The fraction of the whole that the integral has reached at time ``t``."""
        parts = []
        for start, length, w, slope, _ in self.pieces:
            s = F.greatest(F.lit(0.0), F.least(t - F.lit(float(start)), F.lit(float(length))))
            parts.append(s * (F.lit(float(w)) + F.lit(float(slope / 2)) * s))
        return sum(parts[1:], parts[0]) / F.lit(float(self.weight))


#: Integrals 5, 2 and 1: high at first and falling, highest in the middle, rising to the end.
SCHEDULES = (Schedule(((0, 7.5), (1, 2.5))), Schedule(((0, 1), (0.5, 3), (1, 1))), Schedule(((0, 0.5), (1, 1.5))))


def sized(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, key, size, h)``: words and place in hash order of each document."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    digest = F.md5(F.concat_ws(":", F.lit(SEED), docs["doc_id"].cast("string"), F.md5(text.cast("binary"))).cast("binary"))
    source = docs["source"].cast("string")
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), source.alias("source"),
                       F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("key"),
                       F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("size"),
                       F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("bigint").alias("h"))


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with their place ``number`` by code point (null last), from 0, for any number of sources."""
    ordered = cut_lineage(sources.orderBy(F.asc_nulls_last("source")).withColumn("_at", F.monotonically_increasing_id()))
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = {r[0]: r[1] for r in ordered.groupBy(part.alias("p")).count().collect()}       # one row a partition
    before, at = {}, 0
    for p in sorted(counts):
        before[p], at = at, at + counts[p]
    offset = F.element_at(F.create_map(*[F.lit(x) for p in sorted(before) for x in (p, before[p])]), part) if before else F.lit(0)
    return ordered.withColumn("number", (offset + row).cast("bigint")).drop("_at")


def targets(sources: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, cap: int = CAP, share: Fraction | int = 1) -> DataFrame:
    """``(key, source, number, kind, source_size, target)`` from ``sources(key, source, source_size)``.

    ``kind`` is the index of the source's schedule: the schedules repeat over the sources by code point."""
    if share > cap:
        raise ValueError("more words are asked for than the sources may give")
    unit = math.lcm(*[s.weight.denominator for s in schedules])
    weights = [int(s.weight * unit) for s in schedules]
    kind = (F.col("number") % len(schedules)).cast("int")
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), F.col("kind") + 1)
    full = cut_lineage(_numbered(sources).withColumn("kind", kind).withColumn("weight", weight).withColumn("most", cap * F.col("source_size")))
    total = int((full.agg(F.sum("source_size")).first()[0] or 0) * Fraction(share))
    # a target is least(most, weight * level / open_weight)
    level, open_weight, known = total, full.agg(F.sum("weight")).first()[0] or 1, -1
    wide = lambda c: c.cast("decimal(38,0)")
    while True:
        above = wide(F.col("weight")) * wide(F.lit(level)) > wide(F.col("most")) * wide(F.lit(open_weight))
        n, stopped, rest = full.agg(F.count(F.when(above, 1)), F.sum(F.when(above, F.col("most"))), F.sum(F.when(~above, F.col("weight")))).first()
        if n == known or not rest:
            break
        known, level, open_weight = n, total - (stopped or 0), rest
    target = F.when(above, F.col("most").cast("double")).otherwise(F.lit(float(level)) * F.col("weight") / F.lit(float(open_weight)))
    return full.select("key", "source", "number", "kind", "source_size", target.alias("target"))


def assign(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, cap: int = CAP, share: Fraction | int = 1) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, positions, token_positions)`` of every document.

    ``taken`` are its words in the mix, repeats counted (the last document of a source's stream may be taken in part);
    ``positions`` holds the training time of each pass that takes it, ``token_positions`` the words before that."""
    rows = materialise(sized(docs))
    n = rows.count()
    bits = max(4, math.ceil(math.log2(math.sqrt(n or 1) / 4 + 1)))
    rows = rows.withColumn("range", F.shiftright("h", 4 * HASH_DIGITS - bits))
    ranges = cut_lineage(rows.groupBy("key", "range").agg(F.first("source").alias("source"), F.sum("size").alias("words")))
    plan = cut_lineage(targets(ranges.groupBy("key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size")), schedules, cap, share))
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    places = (ranges.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
              .join(plan.drop("source"), "key").select("key", "range", "before", "source_size", "target", "kind"))
    inside = Window.partitionBy("key", "range").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(places, ["key", "range"]).withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    goal = F.floor(F.col("target") + 0.5)
    taken = lambda p: F.least(F.greatest(goal - (F.col("start") + p * F.col("source_size")), F.lit(0)), F.col("size"))
    passes = F.filter(F.transform(F.sequence(F.lit(0), F.lit(cap - 1)), lambda p: F.struct(
        F.try_divide(F.col("start") + p * F.col("source_size"), goal).alias("x"), taken(p).alias("words"))), lambda s: s["words"] > 0)
    whole = {r["kind"]: float(r["t"]) for r in plan.groupBy("kind").agg(F.sum("target").alias("t")).collect()}   # a row a schedule

    def pick(x):
        at = F.lit(None).cast("double")
        for k, s in enumerate(schedules):
            at = F.when(F.col("kind") == k, s.position(x)).otherwise(at) if s.weight else at
        return at

    def tokens(t):
        parts = [F.lit(whole[k]) * schedules[k].demand(t) for k in sorted(whole) if schedules[k].weight]
        return sum(parts[1:], parts[0]) if parts else F.lit(None).cast("double")

    return (placed.withColumn("_passes", passes)
            .withColumn("taken", F.coalesce(F.aggregate("_passes", F.lit(0).cast("bigint"), lambda a, s: a + s["words"]), F.lit(0)))
            .withColumn("positions", F.transform("_passes", lambda s: pick(s["x"])))
            .withColumn("token_positions", F.transform("positions", tokens))
            .select("doc_id", "source", "size", "source_size", "target", "taken", F.transform("_passes", lambda s: s["words"]).alias("words"),
                    "positions", "token_positions"))


def training_order(assigned: DataFrame) -> DataFrame:
    """``(doc_id, source, pass, words, position, token_position)`` of everything taken, range-sorted by position."""
    taken = assigned.select("doc_id", "source", F.posexplode(F.arrays_zip("words", "positions", "token_positions")).alias("pass", "p"))
    return taken.select("doc_id", "source", "pass", F.col("p.words").alias("words"), F.col("p.positions").alias("position"),
                        F.col("p.token_positions").alias("token_position")).orderBy("position", "source", "doc_id", "pass")


def report(docs: DataFrame) -> DataFrame:
    """One row per document, range-sorted by its first position (documents not taken last)."""
    first = F.get("positions", F.lit(0))
    return (assign(docs).select("doc_id", "size", "source_size", "target", "taken", F.round(first, 9).alias("position"))
            .orderBy(F.asc_nulls_last("position"), "doc_id"))
