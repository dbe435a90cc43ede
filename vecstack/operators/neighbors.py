"""Exact and approximate k-nearest-neighbour similarity joins.

Exact top-k is an all-pairs problem; it is never materialised as pair rows.

* **broadcast path** — when the train side is proven small (row count × dim ×
  8 bytes ≤ ``broadcast_limit_bytes``), the train matrix is shipped once per
  executor and every query partition runs a BLAS block product and a local
  top-k in ``mapInPandas`` (no shuffle of the query side).
* **pivot path** — otherwise the train rows are partitioned around pivots and a
  query meets only the blocks that the triangle inequality cannot rule out
  (``operators/pivots.py``).  Task memory is bounded by the block size, not by
  the data size.

Order of ties: higher score first, then the smaller train id (the reference's
``argpartition`` order is unspecified).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from vecstack.functions.arrays import NORM_EPS
from vecstack.session import cut_lineage

NEIGHBOR_SCHEMA = "q_id long, t_id long, t_label int, score double, rank int"


def _prep(mat: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        return mat / (np.linalg.norm(mat, axis=1, keepdims=True) + NORM_EPS)
    return mat


SIM_BLOCK_ELEMENTS = 1 << 21      # similarities of a task at a time (16 MiB; keys and places take as much each)
SHIP_LIMIT_BYTES = 128 << 20      # a train side above this is not shipped whole: every Python worker holds a copy


def _local_topk(q_ids, q_mat, t_ids, t_lab, t_mat, t_sq, k, metric):
    """Top-k of one query block against one train block → DataFrame rows.

    Queries are processed in chunks so that the chunk × train similarity block
    stays under ``SIM_BLOCK_ELEMENTS`` whatever the train size."""
    return _rows_of(q_ids, *_local_best(q_mat, t_ids, t_lab, t_mat, t_sq, k, metric))


def _rows_of(q_ids, ids, lab, score) -> pd.DataFrame:
    """Neighbour rows of ``queries × kk`` arrays in rank order."""
    kk = ids.shape[1]
    return pd.DataFrame({"q_id": np.repeat(q_ids, kk), "t_id": ids.ravel(), "t_label": lab.ravel(), "score": score.ravel(),
                         "rank": np.tile(np.arange(1, kk + 1), len(ids))})


def _local_best(q_mat, t_ids, t_lab, t_mat, t_sq, k, metric):
    """``(t_id, t_label, score)`` as ``queries × min(k, train rows)`` arrays, the best first."""
    kk = min(k, len(t_ids))
    n = len(q_mat) if kk else 0
    ids, lab, score = np.zeros((n, kk), np.int64), np.zeros((n, kk), np.int32), np.zeros((n, kk))
    chunk = max(1, min(4096, SIM_BLOCK_ELEMENTS // max(len(t_ids), 1)))
    for s in range(0, n, chunk):
        qm = q_mat[s:s + chunk]
        key = qm @ t_mat.T
        if metric == "cosine":
            np.negative(key, out=key)                     # ascending = best first
        else:
            key *= -2.0
            key += t_sq[None, :]                          # ‖q‖² is constant per row
        sel = np.argpartition(key, kk - 1, axis=1)[:, :kk].copy()
        kth = np.take_along_axis(key, sel, axis=1).max(axis=1)
        ties = (key <= kth[:, None]).sum(axis=1) > kk
        # order the k selected by (key, train id)
        ids_sel = t_ids[sel]
        o = np.argsort(ids_sel, axis=1, kind="stable")
        sel = np.take_along_axis(sel, o, axis=1)
        o = np.argsort(np.take_along_axis(key, sel, axis=1), axis=1, kind="stable")
        sel = np.take_along_axis(sel, o, axis=1)
        for i in np.flatnonzero(ties):                    # rare: exact ties at the k-th place
            cand = np.flatnonzero(key[i] <= kth[i])
            order = np.lexsort((t_ids[cand], key[i, cand]))[:kk]
            sel[i] = cand[order]
        at = slice(s, s + len(qm))
        ids[at], lab[at] = t_ids[sel], t_lab[sel]
        if metric == "cosine":
            score[at] = -np.take_along_axis(key, sel, axis=1)
        else:                                             # exact distances for the k kept
            diff = qm[:, None, :] - t_mat[sel]
            score[at] = np.sqrt((diff * diff).sum(axis=2))
    return ids, lab, score


def _merge_best(a, b, k: int, metric: str):
    """The ``k`` best of two results of ``_local_best`` for the same queries; ties → the smaller train id."""
    ids, lab, score = (np.concatenate([x, y], axis=1) for x, y in zip(a, b))
    order = np.lexsort((ids, -score if metric == "cosine" else score), axis=1)[:, :k]
    return tuple(np.take_along_axis(x, order, axis=1) for x in (ids, lab, score))


def _stack(series) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, 0))
    return np.vstack([np.asarray(v, dtype=np.float64) for v in series])


def knn_topk(query: DataFrame, train: DataFrame, k: int = 5, metric: str = "cosine",
             id_col: str = "row_id", features: str = "features", label: str = "label",
             broadcast_limit_bytes: int = SHIP_LIMIT_BYTES, block_rows: int = 8192) -> DataFrame:
    """J1 (cosine) / J2 (euclidean): ``(q_id, t_id, t_label, score, rank)``, k rows per query.

    ``score`` is the cosine similarity (higher = nearer) or the Euclidean
    distance (lower = nearer).
    """
    if metric not in ("cosine", "euclidean"):
        raise ValueError(metric)
    spark = query.sparkSession
    t = train.select(F.col(id_col).cast("long").alias("t_id"), F.col(label).cast("int").alias("t_label"),
                     F.col(features).alias("tf"))
    q = query.select(F.col(id_col).cast("long").alias("q_id"), F.col(features).alias("qf"))
    if _fits_broadcast(t, broadcast_limit_bytes):
        return _knn_broadcast(spark, q, t, k, metric)
    return _knn_pivots(q, t, k, metric, block_rows)


def _sides(query, train, id_col, features, label):
    t = train.select(F.col(id_col).cast("long").alias("t_id"), F.col(label).cast("int").alias("t_label"),
                     F.col(features).alias("tf"))
    q = query.select(F.col(id_col).cast("long").alias("q_id"), F.col(features).alias("qf"))
    return q, t


def _fits_broadcast(t: DataFrame, broadcast_limit_bytes: int) -> bool:
    stats = t.agg(F.count("*").alias("n"), F.max(F.size("tf")).alias("d")).first()
    return int(stats["n"]) * max(int(stats["d"] or 0), 1) * 8 <= broadcast_limit_bytes


def _vote_rows(top: pd.DataFrame, k: int) -> pd.DataFrame:
    """Vectorised majority of each query's k ranked labels; ties → the nearest (first) one."""
    if len(top) == 0:
        return pd.DataFrame({"q_id": [], "pred": [], "votes": []})
    kk = int(top["rank"].max())
    lab = top["t_label"].to_numpy().reshape(-1, kk)            # rows are (query, rank)-ordered
    counts = (lab[:, :, None] == lab[:, None, :]).sum(axis=2)   # votes for the label at each rank
    j = np.argmax(counts, axis=1)                               # first maximum = nearest on ties
    return pd.DataFrame({"q_id": top["q_id"].to_numpy()[::kk], "pred": lab[np.arange(len(lab)), j],
                         "votes": counts[np.arange(len(lab)), j]})


def _class_fractions(top: pd.DataFrame, classes) -> pd.DataFrame:
    """Vectorised neighbour-class fractions per query, in ``classes`` order."""
    if len(top) == 0:
        return pd.DataFrame({"q_id": [], "proba": []})
    kk = int(top["rank"].max())
    lab = top["t_label"].to_numpy().reshape(-1, kk)
    fr = (lab[:, :, None] == np.asarray(classes)[None, None, :]).mean(axis=1)
    return pd.DataFrame({"q_id": top["q_id"].to_numpy()[::kk], "proba": list(fr)})


def _knn_broadcast(spark, q, t, k, metric, reduce=None, schema=NEIGHBOR_SCHEMA):
    pdf = t.toPandas()                      # bounded by the size check of the caller
    t_ids = pdf["t_id"].to_numpy(np.int64)
    t_lab = pdf["t_label"].to_numpy(np.int32)
    t_mat = _prep(_stack(pdf["tf"]), metric)
    t_sq = (t_mat * t_mat).sum(axis=1) if len(t_mat) else np.zeros(0)
    bc = spark.sparkContext.broadcast((t_ids, t_lab, t_mat, t_sq))

    def run(batches):
        ids, lab, mat, sq = bc.value
        for b in batches:
            if len(b) == 0:
                continue
            qm = _prep(_stack(b["qf"]), metric)
            top = _local_topk(b["q_id"].to_numpy(np.int64), qm, ids, lab, mat, sq, k, metric)
            yield top if reduce is None else reduce(top)

    return q.mapInPandas(run, schema)


def _knn_pivots(q, t, k, metric, block_rows):
    from vecstack.operators.pivots import pivot_topk
    return pivot_topk(q, t, k, metric, t.count(), block_rows)


def knn_append(df: DataFrame, train: DataFrame, k: int = 5, metric: str = "cosine", classes=None,
               features: str = "features", label: str = "label", id_col: str = "row_id",
               broadcast_limit_bytes: int = SHIP_LIMIT_BYTES) -> DataFrame | None:
    """``df`` with ``pred`` (majority label, ties → nearest) or, when ``classes`` is given,
    ``proba`` (neighbour-class fractions) and ``pred`` = its first maximal class, appended in place — one narrow stage, every input
    column passed through, no join back.  ``None`` when the train side is too large to ship
    (callers then use the pivot path)."""
    shipped = ship_train(train, metric, features, label, id_col, broadcast_limit_bytes)
    return None if shipped is None else append_shipped(df, shipped, k, metric, classes, features)


def ship_train(train: DataFrame, metric: str, features: str = "features", label: str = "label", id_col: str = "row_id",
               broadcast_limit_bytes: int = SHIP_LIMIT_BYTES, fold: str | None = None):
    """The train side as arrays in every task (``None``: it is too large), with each row's fold if asked for."""
    t = train.select(F.col(id_col).cast("long").alias("t_id"), F.col(label).cast("int").alias("t_label"), F.col(features).alias("tf"),
                     (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"))
    if not _fits_broadcast(t, broadcast_limit_bytes):
        return None
    pdf = t.toPandas()                      # bounded by the size check above
    of = pdf["fold"].to_numpy(np.int64)
    order = np.argsort(of, kind="stable")   # the rows of a fold stand together: leaving one out takes no copy
    mat = _prep(_stack(pdf["tf"].iloc[order]), metric)
    return train.sparkSession.sparkContext.broadcast(
        (pdf["t_id"].to_numpy(np.int64)[order], pdf["t_label"].to_numpy(np.int32)[order], mat, (mat * mat).sum(axis=1) if len(mat) else np.zeros(0), of[order]))


def append_shipped(df: DataFrame, shipped, k: int, metric: str, classes=None, features: str = "features", without: int | None = None) -> DataFrame:
    """``df`` with the vote (or class fractions) of each row's neighbours among the shipped rows, those of the fold ``without`` left out."""
    fields = list(df.schema.fields) + [StructField("pred", IntegerType(), True)]
    if classes is not None:
        fields.append(StructField("proba", ArrayType(DoubleType(), False), True))

    def run(batches):
        *arrays, fold = shipped.value
        begin, end = (len(fold), len(fold)) if without is None else np.searchsorted(fold, [without, without + 1])
        parts = [[a[at] for a in arrays] for at in (slice(0, begin), slice(end, len(fold)))]
        parts = [p for p in parts if len(p[0])] or parts[:1]
        for b in batches:
            if len(b) == 0:
                continue
            qm = _prep(_stack(b[features]), metric)
            best = _local_best(qm, *parts[0], k, metric)
            for p in parts[1:]:
                best = _merge_best(best, _local_best(qm, *p, k, metric), k, metric)
            top = _rows_of(np.arange(len(b), dtype=np.int64), *best)
            if classes is None:                      # majority, ties → nearest
                extra = {"pred": _vote_rows(top, k)["pred"].to_numpy(np.int32)}
            else:                                    # fractions; pred = first maximal class
                fr = np.vstack(_class_fractions(top, classes)["proba"].to_numpy())
                extra = {"pred": np.asarray(classes, dtype=np.int32)[np.argmax(fr, axis=1)], "proba": list(fr)}
            yield b.assign(**extra)

    return df.mapInPandas(run, StructType(fields))


LSH_SAMPLE = 200               # queries whose exact neighbours tell how many buckets to probe
LSH_RECALL = 0.93              # recall asked for on that sample


def knn_lsh_topk(query: DataFrame, train: DataFrame, k: int = 5, bucket_length: float = 0.5,
                 num_tables: int = 8, metric: str = "cosine", id_col: str = "row_id",
                 features: str = "features", label: str = "label", seed: int = 42,
                 block_rows: int = 8192, recall: float = LSH_RECALL) -> DataFrame:
    """Approximate neighbours by multi-probe random-projection LSH, ``k`` rows for every query (fewer only if
    the train side has fewer).

    In each table a query looks into its own bucket and ``p`` buckets on either side; ``p`` grows (0, 1, 2, 4, …) until the rows found
    for a hash sample of at most ``LSH_SAMPLE`` queries reach ``recall`` against their exact neighbours.  Queries that still have fewer
    than ``k`` rows are searched exactly (:func:`knn_topk`).

    Candidate pairs are never emitted: rows are keyed by ``(table, bucket)``; a bucket with more than ``block_rows`` train rows is split, and
    so are its visiting queries, every ``(table, bucket, train part, query part)`` meets in one ``cogroup`` task that emits its local top-k
    (exact scores), and the candidates are de-duplicated across tables and merged per query by ``row_number``."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    def keyed(df, idn, with_label):
        cols = [F.col(id_col).cast("long").alias(idn), F.col(features).alias("f")]
        if with_label:
            cols.append(F.col(label).cast("int").alias("t_label"))
        out = df.select(*cols)
        if metric == "cosine":                    # unit vectors: Euclidean buckets ≡ cosine buckets
            out = out.withColumn("f", F.zip_with("f", F.array_repeat(
                F.sqrt(F.aggregate("f", F.lit(0.0), lambda acc, x: acc + x * x)) + F.lit(NORM_EPS),
                F.size("f")), lambda x, n: x / n))
        return out.withColumn("v", array_to_vector("f"))

    tv, qv = keyed(train, "t_id", True), keyed(query, "q_id", False)
    if tv.isEmpty():
        return query.sparkSession.createDataFrame([], NEIGHBOR_SCHEMA)
    lsh = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket_length,
                                      numHashTables=num_tables, seed=seed).fit(tv)

    def buckets(df):
        h = lsh.transform(df).withColumn("hb", F.transform("h", lambda vv: vector_to_array(vv)[0].cast("long")))
        return h.select("*", F.posexplode("hb").alias("tbl", "bucket")).drop("v", "h", "hb")

    tb = buckets(tv)
    t_parts = tb.groupBy("tbl", "bucket").agg(F.ceil(F.count("*") / block_rows).cast("long").alias("t_parts"))      # one row per bucket
    keys = ["tbl", "bucket", "tp", "qp"]
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n))

    def pair(qp: pd.DataFrame, tp: pd.DataFrame) -> pd.DataFrame:
        t_mat = _stack(tp["f"])
        t_sq = (t_mat * t_mat).sum(axis=1) if len(t_mat) else np.zeros(0)
        return _local_topk(qp["q_id"].to_numpy(np.int64), _stack(qp["f"]), tp["t_id"].to_numpy(np.int64),
                           tp["t_label"].to_numpy(np.int32), t_mat, t_sq, k, metric)

    def search(queries, probes: int):
        qb = buckets(queries).withColumn("bucket", F.explode(F.sequence(F.col("bucket") - probes, F.col("bucket") + probes)))
        asked = qb.groupBy("tbl", "bucket").agg(F.ceil(F.count("*") / block_rows).cast("long").alias("q_parts"))
        plan = asked.join(t_parts, ["tbl", "bucket"])                     # buckets that hold both
        q = qb.join(plan, ["tbl", "bucket"]).withColumn("qp", part("q_id", "q_parts")).withColumn("tp", every("t_parts"))
        t = tb.join(plan, ["tbl", "bucket"]).withColumn("tp", part("t_id", "t_parts")).withColumn("qp", every("q_parts"))
        cand = (q.select(*keys, "q_id", "f").groupBy(*keys).cogroup(t.select(*keys, "t_id", "t_label", "f").groupBy(*keys))
                .applyInPandas(pair, NEIGHBOR_SCHEMA))
        cand = cand.groupBy("q_id", "t_id").agg(F.first("t_label").alias("t_label"), F.first("score").alias("score"))
        return _ranked(cand, k, metric)

    sample = query.join(F.broadcast(query.select(id_col).orderBy(F.xxhash64(F.lit(seed), id_col)).limit(LSH_SAMPLE)), id_col)
    exact = knn_topk(sample, train, k, metric, id_col, features, label, block_rows=block_rows)
    worst = exact.groupBy("q_id").agg((F.min("score") if metric == "cosine" else F.max("score")).alias("worst"), F.count("*").alias("n")).collect()  # LSH_SAMPLE rows
    worst = query.sparkSession.createDataFrame([tuple(r) for r in worst], "q_id long, worst double, n long")
    total = worst.agg(F.sum("n")).first()[0] or 0
    good = F.col("score") >= F.col("worst") - 1e-9 if metric == "cosine" else F.col("score") <= F.col("worst") + 1e-9
    qs = keyed(sample, "q_id", False)
    probes = 0
    while total and search(qs, probes).join(F.broadcast(worst), "q_id").where(good).count() < recall * total and probes < 1 << 20:
        probes = max(1, 2 * probes)
    found = cut_lineage(search(qv, probes))
    short = query.join(found.groupBy(F.col("q_id").alias(id_col)).agg(F.count("*").alias("_n")), id_col, "left").where("_n is null or _n < %d" % k)
    short = short.select(*query.columns)
    if short.isEmpty():
        return found
    rest = knn_topk(short, train, k, metric, id_col, features, label, block_rows=block_rows)
    return found.join(short.select(F.col(id_col).cast("long").alias("q_id")).distinct(), "q_id", "left_anti").unionByName(rest)


def _ranked(cand: DataFrame, k: int, metric: str) -> DataFrame:
    """The ``k`` best candidates of each query with their rank."""
    order = F.col("score").desc() if metric == "cosine" else F.col("score").asc()
    w = Window.partitionBy("q_id").orderBy(order, F.col("t_id"))
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("q_id", "t_id", "t_label", "score", "rank")


def majority_vote(neigh: DataFrame, key: str = "q_id", vote: str = "t_label",
                  order: str = "rank") -> DataFrame:
    """A5: most frequent ``vote`` per ``key``; ties → the one met first in ``order``."""
    g = neigh.groupBy(key, vote).agg(F.count("*").alias("votes"), F.min(order).alias("first"))
    w = Window.partitionBy(key).orderBy(F.col("votes").desc(), F.col("first").asc())
    return (g.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
             .select(key, F.col(vote).alias("pred"), "votes"))


def knn_classify(query: DataFrame, train: DataFrame, k: int = 5, metric: str = "cosine",
                 id_col: str = "row_id", features: str = "features", label: str = "label",
                 broadcast_limit_bytes: int = SHIP_LIMIT_BYTES, block_rows: int = 8192) -> DataFrame:
    """M3: ``(row_id, pred)`` — majority label among the k nearest (ties → nearest).

    With a broadcastable train side the vote happens inside the top-k task (one narrow
    stage); otherwise the pivot partitions' top-k is voted relationally (A5)."""
    q, t = _sides(query, train, id_col, features, label)
    if _fits_broadcast(t, broadcast_limit_bytes):
        out = _knn_broadcast(query.sparkSession, q, t, k, metric, lambda top: _vote_rows(top, k),
                             "q_id long, pred int, votes long")
    else:
        out = majority_vote(_knn_pivots(q, t, k, metric, block_rows))
    return out.select(F.col("q_id").alias(id_col), F.col("pred").cast("int").alias("pred"))


def knn_proba(query: DataFrame, train: DataFrame, classes, k: int = 5, metric: str = "euclidean",
              id_col: str = "row_id", features: str = "features", label: str = "label",
              broadcast_limit_bytes: int = SHIP_LIMIT_BYTES, block_rows: int = 8192) -> DataFrame:
    """M4: neighbour-class fractions ``(row_id, proba array<double>)`` in class order."""
    q, t = _sides(query, train, id_col, features, label)
    if _fits_broadcast(t, broadcast_limit_bytes):
        out = _knn_broadcast(query.sparkSession, q, t, k, metric, lambda top: _class_fractions(top, classes),
                             "q_id long, proba array<double>")
        return out.select(F.col("q_id").alias(id_col), "proba")
    nb = _knn_pivots(q, t, k, metric, block_rows)
    cnt = F.count("*")
    agg = nb.groupBy("q_id").agg(
        *[(F.sum((F.col("t_label") == int(c)).cast("double")) / cnt).alias(f"_p{i}")
          for i, c in enumerate(classes)])
    return agg.select(F.col("q_id").alias(id_col),
                      F.array(*[F.col(f"_p{i}") for i in range(len(classes))]).alias("proba"))
