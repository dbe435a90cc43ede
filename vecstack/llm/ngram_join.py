"""Operator 4: exact n-gram Jaccard join by grouped prefixes.

Two documents link when ``den * |A ∩ B| >= num * |A ∪ B|`` over their distinct five-word shingles
(75 / 100).  The shingles have one global order: those frequent in the corpus last, the others by
value.  With that order a linked pair shares a shingle of the *index prefix* of the smaller set and
the *probe prefix* of the larger one.

1. Documents with equal probe prefix and equal size collapse into one group; only groups enter the
   inverted index, and only index keys that two groups share are kept.
2. A first round offers every group the few groups it shares most keys with (linear in the groups).
   Its verified links give provisional components, so that a cluster of thousands of near copies is
   joined without looking at its pairs.
3. Sets that a chain of comparisons connects, each of which found half of the union or more in common, are a
   clan (near copies, also those too far apart to link).  The sets of a clan are compared whole, in blocks of one task
   each, which emit only links that join components.
4. A last round goes through the index for sets of *different* clans.  The entries of a key meet inside tasks, in
   blocks as well; pairs that size, position and a sketch of both whole sets do not rule out are the only rows, and
   are verified.  The filters are bounds, so no pair is left out and the result is exact.

Defined results: null, empty and blank texts have an empty set and no link; rows with a null
``doc_id`` come back with a null component and link with nothing; rows repeating a ``doc_id`` are
one document.  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecstack.llm.common import (batches_of, components, cut_lineage, fresh, materialise, own_columns, texts,
                                 with_membership)

SHINGLE, NUM, DEN = 5, 75, 100
HOT_SHARE = 0.002      # a shingle in this share of the texts handled at once is a candidate for "frequent"
HOT_LEAST = 6          # ... and in this number of them
OFFERS = 4             # partners offered to a group in the first round; only the amount of work depends on it
FAMILY = 4000          # sets of one block of a clan; only the amount of work depends on it
KEY_BLOCK = 4000       # entries of one block of a key; only the amount of work depends on it
SKETCHES = 1 << 10, 1 << 15    # fewest and most bits of a sketch; only the amount of work depends on it
HOT_LIMIT = 1 << 17    # length of the list of frequent shingles (1 MiB); it only sets the order


def probe_length(n: int, num: int = NUM, den: int = DEN) -> int:
    return n + (-num * n // den) + 1


def index_length(n: int, num: int = NUM, den: int = DEN) -> int:
    return n + (-2 * num * n // (num + den)) + 1


SLICE = 1000           # texts handled at once by a Python worker


def _slices(parts):
    for pdf in parts:
        for i in range(0, len(pdf), SLICE):
            yield pdf.iloc[i:i + SLICE]


def _sets(column, k):
    from vecstack.llm.words import Block, blocks, encode
    raw = encode(column)
    for i, j in blocks(raw):
        for d, s in enumerate(Block(raw[i:j]).shingle_sets(k)):
            yield i + d, s


def frequent_shingles(docs: DataFrame, k: int = SHINGLE):
    """The most frequent shingle values, rarest first, as a broadcast array of bounded length."""
    import numpy as np

    def count(parts):
        import pandas as pd
        for pdf in _slices(parts):
            found = [s for _, s in _sets(pdf["text"], k)]
            values, n = np.unique(np.concatenate(found), return_counts=True)
            keep = n >= max(HOT_LEAST, HOT_SHARE * len(pdf))
            yield pd.DataFrame({"key": values[keep].view(np.int64), "n": n[keep]})

    top = (docs.select("text").mapInPandas(count, "key bigint, n bigint").groupBy("key")
           .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(HOT_LIMIT).collect())
    hot = np.array([r["key"] for r in reversed(top)], np.int64).view(np.uint64)
    return docs.sparkSession.sparkContext.broadcast(hot)


class _Order:
    """Puts a sorted set into the global order."""

    def __init__(self, hot):
        import numpy as np
        self.rank = np.argsort(hot, kind="stable")
        self.values = hot[self.rank]

    def frequent(self, s):
        """``(whether frequent, place in the list)`` of shingles."""
        import numpy as np
        if not len(self.values):
            return np.zeros(len(s), bool), np.zeros(len(s), np.int64)
        at = np.minimum(np.searchsorted(self.values, s), len(self.values) - 1)
        return self.values[at] == s, at

    def prefix(self, s, length):
        import numpy as np
        is_hot, at = self.frequent(s)
        cold = s[~is_hot]
        if len(cold) >= length:
            return cold[:length]
        return np.concatenate([cold, s[is_hot][np.argsort(self.rank[at[is_hot]])]])[:length]


def _fold(values, salt):
    import numpy as np

    from vecstack.llm.words import mix
    with np.errstate(over="ignore"):
        x = mix(values ^ np.uint64(salt))
        return np.uint64(len(values)) * np.uint64(0x9E3779B97F4A7C15) ^ np.add.reduce(x * (x >> np.uint64(7) | np.uint64(1)))


def _signed(xs):
    import numpy as np
    return np.array(xs, np.uint64).view(np.int64)


def _sketch(s) -> bytes:
    """Parities of the numbers of shingles in about ``len(s)`` classes (a power of two): two sets differ in at least as many
    shingles as their sketches in bits, also when the longer one is folded to the length of the other."""
    import numpy as np

    from vecstack.llm.words import mix
    bits = min(SKETCHES[1], max(SKETCHES[0], 1 << max(0, len(s) - 1).bit_length()))
    return np.packbits(np.bincount((mix(s) % np.uint64(bits)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def _differing(sketches, i, j):
    """Differing bits of the sketches ``i`` and ``j``, the longer one of a pair folded; no length is over twice the other."""
    import numpy as np
    size = np.array([len(x) for x in sketches])
    out = np.zeros(len(i), np.int64)
    least = np.minimum(size[i], size[j])
    for w in np.unique(least):
        of = np.flatnonzero(least == w)
        rows, at = np.unique(np.concatenate([i[of], j[of]]), return_inverse=True)
        bits = np.zeros((len(rows), w // 8), np.uint64)
        for r, m in enumerate(rows):
            bits[r] = np.bitwise_xor.reduce(np.frombuffer(sketches[m], np.uint64).reshape(-1, w // 8), axis=0)
        step = (1 << 24) // int(w)
        for s in range(0, len(of), step):
            part = of[s:s + step]
            a, b = at[s:s + len(part)], at[len(of) + s:len(of) + s + len(part)]
            out[part] = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
    return out


def shingle_sets(docs: DataFrame, hot, k: int = SHINGLE) -> DataFrame:
    """``(doc_id, n, fp_a, fp_b, gid, sketch)``: set size, set fingerprint, group of (prefix, size), sketch of the set."""
    def run(parts):
        import pandas as pd
        order = _Order(hot.value)
        for pdf in _slices(parts):
            n, a, b, g, bits = [], [], [], [], []
            for _, s in _sets(pdf["text"], k):
                n.append(len(s))
                a.append(_fold(s, 0x51))
                b.append(_fold(s, 0xA7C3))
                g.append(_fold(order.prefix(s, probe_length(len(s))), 2 * len(s) + 1) if len(s) else 0)
                bits.append(_sketch(s))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n": n, "fp_a": _signed(a), "fp_b": _signed(b), "gid": _signed(g), "sketch": bits})

    return docs.mapInPandas(run, "doc_id bigint, n bigint, fp_a bigint, fp_b bigint, gid bigint, sketch binary")


def shared_index(docs: DataFrame, hot, k: int = SHINGLE) -> DataFrame:
    """Entries ``(key, gid, n, pos, groups)`` of the keys that at least two groups have.

    Entries travel as arrays by key bucket; a key held by one group is dropped in its task.  The
    frequent keys are shared for certain, so their entries are spread over all buckets.
    """
    spark = docs.sparkSession
    n_buckets = max(1024, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = "bucket int, keys array<bigint>, gids array<bigint>, ns array<int>, poss array<int>"

    def emit(parts):
        import numpy as np
        import pandas as pd

        from vecstack.llm.words import mix
        order = _Order(hot.value)
        for pdf in _slices(parts):
            keys, gids, ns, poss = [], [], [], []
            for _, s in _sets(pdf["text"], k):
                if len(s):
                    p = order.prefix(s, probe_length(len(s)))
                    keys.append(p)
                    gids.append(np.full(len(p), _fold(p, 2 * len(s) + 1)))
                    ns.append(np.full(len(p), len(s), np.int32))
                    poss.append(np.arange(len(p), dtype=np.int32))
            if not keys:
                continue
            keys, gids, ns, poss = map(np.concatenate, (keys, gids, ns, poss))
            spread = np.where(order.frequent(keys)[0], mix(keys ^ gids), keys)
            bucket = (spread % np.uint64(n_buckets)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[by])) + 1
            split = lambda x: np.split(x[by], cut)
            yield pd.DataFrame({"bucket": [int(b[0]) for b in split(bucket)],
                                "keys": split(keys.view(np.int64)), "gids": split(gids.view(np.int64)),
                                "ns": split(ns), "poss": split(poss)})

    def keep_shared(parts):
        import numpy as np
        import pandas as pd
        order = _Order(hot.value)

        def flush(got):
            keys, gids, ns, poss = map(np.concatenate, got)
            by = np.lexsort((gids, keys))
            keys, gids, ns, poss = keys[by], gids[by], ns[by], poss[by]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (gids[1:] != gids[:-1])     # copies within a group
            keys, gids, ns, poss = keys[new], gids[new], ns[new], poss[new]
            same = keys[1:] == keys[:-1]
            shared = np.zeros(len(keys), bool)
            shared[1:] |= same
            shared[:-1] |= same
            shared |= order.frequent(keys.view(np.uint64))[0]
            rows = np.flatnonzero(shared)
            head = np.flatnonzero(np.concatenate([[True], ~same]))
            count = np.repeat(np.diff(np.append(head, len(keys))), np.diff(np.append(head, len(keys))))
            for i in range(0, len(rows), 200_000):
                r = rows[i:i + 200_000]
                yield pd.DataFrame({"key": keys[r], "gid": gids[r], "n": ns[r].astype(np.int64), "pos": poss[r].astype(np.int64),
                                    "groups": count[r]})

        at, got = None, [[], [], [], []]                    # one bucket at a time
        for pdf in parts:
            for row in zip(pdf["bucket"], pdf["keys"], pdf["gids"], pdf["ns"], pdf["poss"]):
                if row[0] != at and got[0]:
                    yield from flush(got)
                    got = [[], [], [], []]
                at = row[0]
                for out, x in zip(got, row[1:]):
                    out.append(x)
        if got[0]:
            yield from flush(got)

    return (docs.select("text").mapInPandas(emit, schema).repartition("bucket").sortWithinPartitions("bucket")
            .mapInPandas(keep_shared, "key bigint, gid bigint, n bigint, pos bigint, groups bigint"))


def _sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``(rep, n, items)``: the shingle sets of the wanted ``(rep, fp_a, fp_b)``."""
    def run(parts):
        import numpy as np
        import pandas as pd
        for pdf in _slices(parts):
            keep = [(i, s) for i, s in _sets(pdf["text"], k)
                    if (_signed([_fold(s, 0x51)])[0], _signed([_fold(s, 0xA7C3)])[0]) == (pdf["fp_a"].iat[i], pdf["fp_b"].iat[i])]
            if keep:
                yield pd.DataFrame({"rep": [int(pdf["doc_id"].iat[i]) for i, _ in keep], "n": [len(s) for _, s in keep],
                                    "items": [s.view(np.int64) for _, s in keep]})

    reps = cut_lineage(wanted.select(F.col("rep").alias("doc_id"), "fp_a", "fp_b"))
    asked = with_membership(docs, "doc_id", reps, "doc_id").where("__listed").drop("__listed")
    return asked.join(reps, "doc_id").mapInPandas(run, "rep bigint, n bigint, items array<bigint>")


def _plausible(pairs: DataFrame, shared: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``(x_gid, y_gid, ...)`` of groups whose prefixes have enough in common.

    Up to the end of the prefix that ends first, all common shingles are common index keys; beyond
    it at most the rest of that set is common.
    """
    side = lambda p: shared.select(F.col("gid").alias(p + "_gid"), F.col("n").alias(p + "_n"), F.col("keys").alias(p + "_keys"))
    rest = lambda p: f"-cast(floor(-{num} * {p}_n / {den}) as bigint) - 1"
    both = pairs.join(side("y"), "y_gid").join(side("x"), "x_gid")
    return both.where(f"{num + den} * (size(array_intersect(x_keys, y_keys)) + greatest({rest('x')}, {rest('y')})) "
                      f">= {num} * (x_n + y_n)").select(*pairs.columns)


def _compared(pairs: DataFrame, docs: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """``pairs(a, b)`` of representatives with the sizes and the intersection of their whole sets: ``(a, b, na, nb, i)``."""
    pairs = cut_lineage(pairs.distinct())
    wanted = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    sets = materialise(_sets_of(docs, reps.join(wanted, "rep"), k))
    a = sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("items").alias("ia"))
    b = sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("items").alias("ib"))
    both = pairs.join(b, "b").join(a, "a")
    return both.select("a", "b", "na", "nb", F.size(F.array_intersect("ia", "ib")).alias("i"))


def _linked(compared: DataFrame, num: int, den: int) -> DataFrame:
    return compared.where(den * F.col("i") >= num * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b")


def _clans(compared: DataFrame) -> DataFrame:
    """``(rep, clan)``: sets connected by comparisons that found half of the union or more in common; other sets are not listed."""
    alike = compared.where("2 * i >= na + nb - i").select("a", "b")
    return components(alike).select(F.col("node").alias("rep"), F.col("component").alias("clan"))


def _in_blocks(rows: DataFrame) -> DataFrame:
    """``rows`` of groups of ``parts`` blocks, each row once for every pair ``(x, y)`` of blocks that its own block (``own``) is in."""
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")) \
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.withColumn("x", F.least("own", "with")).withColumn("y", F.greatest("own", "with")).drop("parts", "with")


def _clan_links(member: DataFrame, docs: DataFrame, reps: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links ``(a, b)`` that join components of the sets ``member(rep, comp, clan)`` of one clan, all of them compared.

    The whole sets of a clan meet once, in blocks of ``FAMILY`` sets (all pairs of blocks); pairs never become rows."""
    several = member.groupBy("clan").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).where("lo < hi")
    family = cut_lineage(member.join(several.select("clan", F.ceil(F.col("n") / FAMILY).cast("int").alias("parts")), "clan")
                         .select("clan", "rep", "comp", "parts").distinct())
    sets = materialise(_sets_of(docs, reps.join(family.select("rep"), "rep"), k))

    def run(parts):
        from vecstack.llm.sets import group_links
        yield from group_links(parts, ["clan", "x", "y"], "rep", num, den)

    by = ["clan", "x", "y"]
    met = _in_blocks(family).join(sets.select("rep", "items"), "rep").repartition(*by).sortWithinPartitions(*by)
    return met.mapInPandas(run, "a bigint, b bigint")


_ENTRY = "key bigint, gid bigint, rep bigint, clan bigint, n bigint, pos bigint, k bigint"


def _met(entries: DataFrame, num: int, den: int, sketched: bool = False) -> DataFrame:
    """What entries of one key and different clans leave after the filters, of ``entries(key, gid, rep, clan, n, pos, k, parts)``.

    Without sketches these are the entries that meet a possible partner; with the column ``sketch`` the pairs ``(a, b)``
    themselves.  The entries of a key are compared inside tasks, in blocks of ``KEY_BLOCK`` (all pairs of blocks)."""
    by = ["key", "x", "y"]

    def run(parts):
        import numpy as np
        import pandas as pd

        from vecstack.llm.sets import pairs_between, whole_groups
        for pdf in whole_groups(parts, by):
            pdf = pdf.reset_index(drop=True)
            key, clan, n, pos, k, rep, own, x, y = (pdf[c].to_numpy(np.int64) for c in ("key", "clan", "n", "pos", "k", "rep", "own", "x", "y"))
            new = (key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            group = np.concatenate([[0], np.cumsum(new)])
            index_end = n + -2 * num * n // (num + den) + 1
            rest = -(-num * n // den) - 1
            met, pairs = np.zeros(len(pdf), bool), []
            for i, j in pairs_between(group, clan):
                ni, nj, both = n[i], n[j], n[i] + n[j]
                ok = (den * np.minimum(ni, nj) >= num * np.maximum(ni, nj)) & ((own[i] != own[j]) | (x[i] == y[i]))
                ok &= (num + den) * (np.minimum(pos[i], pos[j]) + np.minimum(ni - pos[i], nj - pos[j])) >= num * both
                ok &= (num + den) * (np.minimum(k[i], k[j]) + np.maximum(rest[i], rest[j])) >= num * both
                # the key is in the index prefix of the smaller set; of equal sets, of either
                ok &= ((ni <= nj) & (pos[i] < index_end[i])) | ((nj <= ni) & (pos[j] < index_end[j]))
                i, j, both = i[ok], j[ok], both[ok]
                if sketched:
                    near = (num + den) * _differing(pdf["sketch"], i, j) <= (den - num) * both
                    a, b = rep[i[near]], rep[j[near]]
                    pairs.append(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1))
                else:
                    met[i] = met[j] = True
            if sketched and pairs:
                yield pd.DataFrame(np.unique(np.concatenate(pairs), axis=0), columns=["a", "b"])
            elif met.any():
                yield pdf.loc[met, ["key", "gid", "rep", "clan", "n", "pos", "k"]]

    rows = _in_blocks(entries).repartition(*by).sortWithinPartitions(*by, "clan")
    return rows.mapInPandas(run, "a bigint, b bigint" if sketched else _ENTRY)


def _between_clans(member: DataFrame, index: DataFrame, shared: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs ``(a, b)`` of sets ``member(rep, gid, n, clan)`` of different clans that the filters do not rule out."""
    blocks = F.ceil(F.col("c") / KEY_BLOCK).cast("int").alias("parts")
    unit = cut_lineage(member.groupBy("gid").agg(F.min("clan").alias("lo"), F.max("clan").alias("hi"), F.count("*").alias("c")))
    keys = index.select("key", "gid").join(unit, "gid").groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("c").alias("c"))
    entries = (index.join(keys.where("lo < hi").select("key", blocks), "key").join(member.select("gid", "rep", "clan"), "gid")
               .join(shared.select("gid", F.size("keys").cast("bigint").alias("k")), "gid")
               .select("key", "gid", "rep", "clan", "n", "pos", "k", "parts"))
    # sets of one group have all of their prefix in common, whether or not another group shares a key of it
    same = member.join(unit.where("lo < hi").select("gid", blocks), "gid").select(
        F.col("gid").alias("key"), "gid", "rep", "clan", "n", F.lit(0).cast("bigint").alias("pos"), F.col("n").alias("k"), "parts")
    left = materialise(_met(entries.union(same), num, den).distinct())
    keys = left.groupBy("key").agg(F.count("*").alias("c")).select("key", blocks)
    sketches = sets.select(F.col("doc_id").alias("rep"), "gid", "sketch").join(left.select("rep", "gid").distinct(), ["rep", "gid"]).distinct()
    return _met(left.join(keys, "key").join(sketches, ["rep", "gid"]), num, den, sketched=True)


def jaccard_components(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row for each row of ``docs(doc_id, text)``."""
    if 2 * num < den:
        raise ValueError("the prefixes are laid out for thresholds of one half or more")
    with batches_of(docs.sparkSession, SLICE):         # every Python step below is run inside
        return _components_of(texts(docs), k, num, den)


def _components_of(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    named = docs.where("doc_id is not null")
    hot = frequent_shingles(named, k)
    sets = cut_lineage(shingle_sets(docs, hot, k))
    reps = cut_lineage(sets.where("doc_id is not null and n > 0").groupBy("fp_a", "fp_b")
                       .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("gid").alias("gid")))
    index = materialise(shared_index(named, hot, k))
    shared = cut_lineage(index.groupBy("gid").agg(F.first("n").alias("n"), F.collect_list("key").alias("keys"),
                                                   (F.sum("groups") / (F.first("n") + 1)).alias("weight")))
    head = reps.groupBy("gid").agg(F.min("rep").alias("head"))

    # round 1: a few partners for each group, and the first set of each group for its other sets
    # (of a cluster of near copies, the text they come from shares most keys with most others)
    lead = index.join(shared.select("gid", "weight"), "gid").groupBy("key").agg(F.max(F.struct("weight", "gid", "n")).alias("m"))
    offer = (index.join(lead, "key").where(f"gid <> m.gid and {den} * m.n >= {num} * n and {den} * n >= {num} * m.n")
             .groupBy("gid", F.col("m.gid").alias("other")).agg(F.count("*").alias("c"))
             .groupBy("gid").agg(F.sort_array(F.collect_list(F.struct("c", "other")), asc=False).alias("best"))
             .select(F.col("gid").alias("x_gid"), F.explode(F.slice("best", 1, OFFERS)).alias("best"))
             .select("x_gid", F.col("best.other").alias("y_gid")))
    pairs = (_plausible(offer, shared, num, den)
             .join(head.select(F.col("gid").alias("x_gid"), F.col("head").alias("a")), "x_gid")
             .join(head.select(F.col("gid").alias("y_gid"), F.col("head").alias("b")), "y_gid").select("a", "b")
             .union(reps.join(head, "gid").where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b"))))
    compared = materialise(_compared(pairs, named, reps, k))
    comp = cut_lineage(components(_linked(compared, num, den)).withColumnRenamed("node", "rep"))

    # sets of one clan meet whole; then every pair of different clans that the filters leave
    member = cut_lineage(reps.join(comp, "rep", "left").join(_clans(compared), "rep", "left").select(
        "rep", "gid", "n", F.coalesce("component", "rep").alias("comp"), F.coalesce("clan", "rep").alias("clan")))
    inside = cut_lineage(_clan_links(member.select("rep", "comp", "clan"), named, reps, k, num, den))
    second = _linked(_compared(_between_clans(member, index, shared, sets, num, den), named, reps, k), num, den)
    star = comp.where("rep <> component").select(F.col("rep").alias("a"), F.col("component").alias("b"))
    # several sets under one doc_id are one document
    own = sets.where("doc_id is not null and n > 0").join(reps.select("fp_a", "fp_b", "rep"), ["fp_a", "fp_b"]) \
        .groupBy("doc_id").agg(F.collect_set("rep").alias("reps")).where("size(reps) > 1")
    own = own.select(F.array_min("reps").alias("a"), F.explode("reps").alias("b"))
    final = components(star.union(inside).union(second).union(own))
    rep_comp = (reps.select("fp_a", "fp_b", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left")
                .select("fp_a", "fp_b", F.coalesce("component", "rep").alias("component")))
    out = sets.join(rep_comp, ["fp_a", "fp_b"], "left")
    one = Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("fp_a")))     # a document without text may have other rows
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.min(F.coalesce("component", "doc_id")).over(one)).alias("component_id"))


def one_per_component(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component, each once (of rows sharing a ``doc_id`` the one
    of the smallest text, an empty or null one last, then of the smallest other columns).  Rows with a null ``doc_id`` are kept."""
    comp = cut_lineage(jaccard_components(docs, **options).where("doc_id is not null"))
    several = comp.groupBy("doc_id").agg(F.count("*").alias("rows"), F.first("component_id").alias("head"))
    # most rows are neither repeated nor in another document's component: those stay where they are
    listed, own, gone, row = fresh(docs, "__listed", "__id", "__gone", "__row")
    several = cut_lineage(several.where("rows > 1 or head <> doc_id").select(F.col("doc_id").alias(own), (F.col("head") != F.col("doc_id")).alias(gone)))
    rows = with_membership(docs, "doc_id", several, own, listed)
    apart = F.col(listed) & F.col("doc_id").isNotNull()
    rest = rows.where(apart).join(several.where(F.col(gone)).select(own), F.col("doc_id").cast("bigint") == F.col(own), "left_anti")
    whole = F.struct(*own_columns(docs)).alias(row)
    first = F.struct(F.coalesce(F.col("text").cast("string"), F.lit("")) == "", F.col("text"), F.to_json(F.struct(*own_columns(docs))))
    one = rest.groupBy("doc_id").agg(F.min_by(whole, first).alias(row)).select(F.col(row + ".*"))
    return rows.where(~apart).select(*own_columns(docs)).union(one)
