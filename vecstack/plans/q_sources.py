"""Queries S1-S7 (sources / sinks) and R1-R5, J4, J5 (sampling, folds, OOF alignment)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from vecstack.functions.hashing import sql_hash
from vecstack.operators import neighbors as nb
from vecstack.operators import sampling as R
from vecstack.plans.flows import FeatureConfig
from vecstack.plans.registry import EMB, big, long_sql, r, register, rnd
from vecstack.session import cut_lineage
from vecstack.sources import files as io
from vecstack.sources.tables import labelled_vectors, read_table, with_split

D = 64
SEED = 42


# S1 / S2 -------------------------------------------------------------------
@register("read_labeled_csv", f"""
SELECT label::BIGINT AS label, {", ".join(f"{r(f'embedding[{i + 1}]')} AS f{i:02d}" for i in range(D))}
FROM embeddings""")
def q_read_csv(spark, sf):
    path = io.scratch_path(spark, "labeled-csv")
    io.write_labeled_csv(labelled_vectors(spark, sf), path, n_features=D)
    df = io.read_labeled_csv(spark, path, n_features=D, dtype="float")
    return df.select(big("label").alias("label"), *[rnd(F.col("features")[i]).alias(f"f{i:02d}") for i in range(D)])


# S3 / S4 -------------------------------------------------------------------
def _written_table(spark, sf):
    path = io.scratch_path(spark, "feature-table")
    io.write_feature_table(with_split(labelled_vectors(spark, sf)), path)
    return path


_FT_SQL = f"""
WITH e AS ({EMB}), l AS ({long_sql("SELECT * FROM e", "f")}),
n AS (SELECT row_id, sqrt(sum(v * v)) + 1e-12 AS nrm FROM l GROUP BY row_id),
t AS (SELECT l.row_id, CASE WHEN l.row_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, l.label, l.dim,
             CAST(CAST(l.v AS FLOAT) AS DOUBLE) AS value,
             CAST(CAST(l.v / n.nrm AS FLOAT) AS DOUBLE) AS value_norm FROM l JOIN n USING (row_id))"""


@register("write_feature_table", _FT_SQL + f"""
SELECT row_id, split, label::BIGINT AS label, dim, {r("value")} AS value, {r("value_norm")} AS value_norm FROM t""")
def q_write_ft(spark, sf):
    path = _written_table(spark, sf)
    back = io.read_feature_table(spark, path, columns=("row_id", "label", "split", "features", "features_norm"))
    z = back.select("row_id", "split", "label",
                    F.posexplode(F.arrays_zip("features", "features_norm")).alias("dim", "z"))
    return z.select("row_id", "split", big("label").alias("label"), big("dim").alias("dim"),
                    rnd("z.features").alias("value"), rnd("z.features_norm").alias("value_norm"))


@register("read_feature_table", _FT_SQL + f"""
SELECT row_id, label::BIGINT AS label, dim, {r("value_norm")} AS value_norm FROM t WHERE split = 'train'""")
def q_read_ft(spark, sf):
    path = _written_table(spark, sf)
    back = io.read_feature_table(spark, path, split="train", columns=("row_id", "label", "features_norm"))
    z = back.select("row_id", "label", F.posexplode("features_norm").alias("dim", "v"))
    return z.select("row_id", big("label").alias("label"), big("dim").alias("dim"), rnd("v").alias("value_norm"))


# S5-S7 (fingerprints depend on file paths: rows-only) ----------------------
def _sources(sf):
    return {"train": f"{sf.rstrip('/')}/embeddings.parquet", "val": f"{sf.rstrip('/')}/lineitem.parquet"}


#: The build parameters that a manifest records (those of the default feature build).
MANIFEST_PARAMS = FeatureConfig().manifest_params()


def _contents(spark, sf):
    """The two sources as tables whose contents a manifest records: integers and text, so that every engine shows them alike."""
    emb = read_table(spark, sf, "embeddings").select(
        "vec_id", "label", F.array_join(F.transform("embedding", lambda x: F.round(x.cast("double") * 1e6).cast("bigint")), ",").alias("v"))
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))
    return {"train": emb, "val": li}


_CONTENT_COLUMNS = {
    "train": ("embeddings", ("vec_id", "label", "array_to_string(list_transform(embedding, lambda x: round(x::DOUBLE * 1e6)::BIGINT), ',')")),
    "val": ("lineitem", ("l_orderkey", "l_linenumber", "l_returnflag", "round(l_extendedprice * 100)::BIGINT"))}


def _content_sql(name: str, table: str | None = None, label: str = "label") -> str:
    """``(n_rows, fingerprint)`` of the contents of a source."""
    of, cols = _CONTENT_COLUMNS[name]
    shown = ", ".join(f"coalesce('=' || ({label if c == 'label' else c})::VARCHAR, '')" for c in cols)
    part = lambda at: f"coalesce(sum(('0x' || substr(m, {at}, 15))::BIGINT::HUGEINT), 0)::HUGEINT::VARCHAR"
    return (f"SELECT count(*)::BIGINT AS n_rows, md5(count(*)::VARCHAR || ':' || {part(1)} || ':' || {part(16)}) AS fingerprint "
            f"FROM (SELECT md5(concat_ws('|', {shown})) AS m FROM {table or of})")


def _manifest_sql() -> str:
    p = MANIFEST_PARAMS
    return (f"WITH t AS ({_content_sql('train')}), v AS ({_content_sql('val')}) "
            f"SELECT {p['pca_var']}::DOUBLE AS pca_var, '{json.dumps(p['hog'])}' AS hog, "
            f"'{json.dumps(p['directional'])}' AS directional, '{json.dumps(p['zonal'])}' AS zonal, "
            f"'{p['dtype']}' AS dtype, 2::BIGINT AS n_sources, 40::BIGINT AS sha1_len, t.n_rows AS train_rows, "
            f"t.fingerprint AS train_content, v.n_rows AS val_rows, v.fingerprint AS val_content FROM t, v")


@register("write_manifest", _manifest_sql())
def q_write_manifest(spark, sf):
    """Manifest of the contents of two tables and of their files, written and read back (the files' SHA-1s
    depend on how they were written: only their number and length are shown)."""
    path = io.scratch_path(spark, "manifest")
    sources = _sources(sf)
    m = io.manifest_frame(spark, sources, MANIFEST_PARAMS, build_seconds=0.0, tables=_contents(spark, sf))
    io.write_manifest(m, path)
    back = io.read_manifest(spark, path)
    sha = [F.col(f"{n}_sha1") for n in sources]
    return back.select("pca_var", "hog", "directional", "zonal", "dtype",
                       F.lit(len(sources)).cast("bigint").alias("n_sources"),
                       F.least(*[F.length(c) for c in sha]).cast("bigint").alias("sha1_len"),
                       *[c for n in sources for c in (big(f"{n}_rows").alias(f"{n}_rows"), F.col(f"{n}_content"))])


@register("file_fingerprint")
def q_fingerprint(spark, sf):
    """The files of every given table, with the rows that Spark reads from each of the labelled table's files."""
    fp = io.file_fingerprints(spark, [f"{sf.rstrip('/')}/embeddings.parquet", f"{sf.rstrip('/')}/lineitem.parquet"])
    held = None
    for t in ("embeddings", "lineitem"):
        rows = read_table(spark, sf, t).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n_rows"))
        held = rows if held is None else held.union(rows)
    return fp.join(held, "path", "left").select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "length", "sha1",
                                                F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


_CHANGED = "CASE WHEN vec_id % 97 = 3 THEN label + 1 ELSE label END"


@register("stale_check", f"""
WITH t AS ({_content_sql('train')}), v AS ({_content_sql('val')}), c AS ({_content_sql('train', label=_CHANGED)})
SELECT 'train' AS source, t.n_rows AS recorded_rows, c.n_rows AS current_rows, t.fingerprint AS recorded, c.fingerprint AS current,
       t.fingerprint <> c.fingerprint AS stale FROM t, c
UNION ALL SELECT 'val', n_rows, n_rows, fingerprint, fingerprint, false FROM v""")
def q_stale(spark, sf):
    """A manifest of two tables, checked after some labels of the first one have changed."""
    now = _contents(spark, sf)
    m = io.manifest_frame(spark, _sources(sf), MANIFEST_PARAMS, build_seconds=0.0, tables=now)
    now["train"] = now["train"].withColumn("label", F.expr(_CHANGED))
    s = io.stale_tables(m, now)
    return s.select("source", big("recorded_rows").alias("recorded_rows"), big("current_rows").alias("current_rows"), "recorded", "current", "stale")


# R1 ------------------------------------------------------------------------
_H_FOLD = sql_hash("'42:fold:' || row_id::VARCHAR")
FOLDS3_SQL = f"""
WITH e AS ({EMB}),
k AS (SELECT row_id, label, f, ntile(3) OVER (ORDER BY {_H_FOLD}, row_id) - 1 AS fold FROM e)"""


@register("kfold_assign", FOLDS3_SQL + "\nSELECT row_id, fold::BIGINT AS fold FROM k")
def q_kfold(spark, sf):
    k = R.kfold_assign(labelled_vectors(spark, sf), cv=3, seed=SEED)
    return k.select("row_id", big("fold").alias("fold"))


# R2 ------------------------------------------------------------------------
@register("stratified_kfold", f"""
WITH e AS ({EMB})
SELECT row_id, ((row_number() OVER (PARTITION BY label ORDER BY {sql_hash("'42:strat:' || row_id::VARCHAR")},
       row_id) - 1) % 5)::BIGINT AS fold FROM e""")
def q_strat(spark, sf):
    k = R.stratified_kfold(labelled_vectors(spark, sf), cv=5, seed=SEED)
    return k.select("row_id", big("fold").alias("fold"))


@register("stratified_kfold_chunks", f"""
WITH e AS ({EMB})
SELECT row_id, (ntile(5) OVER (PARTITION BY label ORDER BY {sql_hash("'42:strat:' || row_id::VARCHAR")}, row_id) - 1)::BIGINT AS fold FROM e""")
def q_strat_chunks(spark, sf):
    """R2 by cut-offs: the rows stay where they are."""
    k = R.stratified_kfold(labelled_vectors(spark, sf), cv=5, seed=SEED, deal="chunks")
    return k.select("row_id", big("fold").alias("fold"))


# R3 ------------------------------------------------------------------------
BOOT_SQL = f"""
WITH RECURSIVE e AS ({EMB}),
lam AS (SELECT greatest(1000, floor(0.35::DOUBLE * count(*)))::DOUBLE / count(*) AS lam FROM e),
cdf(k, p, c) AS (SELECT 0, exp(-lam), exp(-lam) FROM lam
                 UNION ALL SELECT k + 1, p * (lam / (k + 1)), c + p * (lam / (k + 1)) FROM cdf, lam
                 WHERE NOT (c >= 1 - 1e-15 OR k + 1 > 10 * lam + 50)),
t AS (SELECT e.row_id, tr.range AS tree FROM e, range(3) tr),
u AS (SELECT tree, row_id, {sql_hash("'42:boot:' || tree::VARCHAR || ':' || row_id::VARCHAR")}
             / 4294967296.0::DOUBLE AS u FROM t),
w AS (SELECT u.tree, u.row_id, count(cdf.c) AS w FROM u LEFT JOIN cdf ON cdf.c <= u.u GROUP BY 1, 2)
SELECT tree::BIGINT AS tree, row_id, w::BIGINT AS weight FROM w WHERE w > 0"""


@register("bootstrap_sample", BOOT_SQL)
def q_bootstrap(spark, sf):
    df = labelled_vectors(spark, sf)
    w = R.bootstrap_weights(df, n_trees=3, ratio=0.35, seed=SEED, min_rows=1000)
    return w.select(big("tree").alias("tree"), "row_id", big("weight").alias("weight"))


# R4 ------------------------------------------------------------------------
@register("subsample", f"""
WITH e AS ({EMB}), n AS (SELECT count(*) AS n FROM e),
t AS (SELECT e.row_id, rd.range AS round FROM e, range(3) rd),
k AS (SELECT round, row_id, row_number() OVER (PARTITION BY round ORDER BY
        {sql_hash("'42:sub:' || round::VARCHAR || ':' || row_id::VARCHAR")}, row_id) AS rn FROM t)
SELECT round::BIGINT AS round, row_id FROM k, n WHERE rn <= floor(0.6::DOUBLE * n.n)""")
def q_subsample(spark, sf):
    s = R.subsample(labelled_vectors(spark, sf), frac=0.6, rounds=3, seed=SEED, exact=True)
    return s.select(big("round").alias("round"), "row_id")


# J4 ------------------------------------------------------------------------
@register("fold_anti_join", FOLDS3_SQL + """
SELECT f.range::BIGINT AS train_fold, k.row_id FROM k, range(3) f WHERE k.fold <> f.range""")
def q_fold_anti(spark, sf):
    k = R.kfold_assign(labelled_vectors(spark, sf), cv=3, seed=SEED)
    t = R.fold_train_rows(k, 3)
    return t.select(big("train_fold").alias("train_fold"), "row_id")


# J5 ------------------------------------------------------------------------
def oof_knn(df, cv=2, k=5, seed=SEED):
    """Out-of-fold kNN labels: each fold predicted by a kNN over the other folds."""
    folded = cut_lineage(R.kfold_assign(df, cv=cv, seed=seed))      # read by every fold's fit
    parts = []
    for f in range(cv):
        q = folded.where(F.col("fold") == f)
        t = folded.where(F.col("fold") != f)
        parts.append(nb.knn_classify(q, t, k=k).withColumnRenamed("pred", "oof_pred"))
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    return folded.select("row_id", "label", "fold").join(oof, "row_id")     # J5: align on row_id


_H_FOLD2 = sql_hash("'42:fold:' || row_id::VARCHAR")


def oof_knn_sql(src: str) -> str:
    """CTEs ``k(row_id, label, f, fold)`` (2 hash folds of ``src``) and ``mv(q_id, pred)``: the
    out-of-fold cosine 5-NN label of every row."""
    return f"""
WITH e AS ({EMB}),
src AS ({src}),
k AS (SELECT row_id, label, f, ntile(2) OVER (ORDER BY {_H_FOLD2}, row_id) - 1 AS fold FROM src),
l AS ({long_sql("SELECT * FROM k", "f", "row_id, fold")}),
nr AS (SELECT row_id, sqrt(sum(v * v)) + 1e-12 AS nrm FROM l GROUP BY row_id),
ln AS (SELECT l.row_id, l.fold, l.dim, l.v / nr.nrm AS v FROM l JOIN nr USING (row_id)),
s AS (SELECT a.row_id AS q_id, b.row_id AS t_id, sum(a.v * b.v) AS score
      FROM ln a JOIN ln b ON a.dim = b.dim AND a.fold <> b.fold GROUP BY 1, 2),
nb AS (SELECT s.q_id, s.t_id, k.label AS t_label,
              row_number() OVER (PARTITION BY s.q_id ORDER BY s.score DESC, s.t_id) AS rank
       FROM s JOIN k ON k.row_id = s.t_id QUALIFY rank <= 5),
v AS (SELECT q_id, t_label AS pred, count(*) AS votes, min(rank) AS first FROM nb GROUP BY 1, 2),
mv AS (SELECT q_id, pred FROM v QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY votes DESC, first) = 1)"""


@register("oof_align", oof_knn_sql("SELECT * FROM e") + """
SELECT k.row_id, k.label::BIGINT AS label, k.fold::BIGINT AS fold, mv.pred::BIGINT AS oof_pred
FROM k JOIN mv ON mv.q_id = k.row_id""")
def q_oof_align(spark, sf):
    o = oof_knn(labelled_vectors(spark, sf), cv=2)
    return o.select("row_id", big("label").alias("label"), big("fold").alias("fold"),
                    big("oof_pred").alias("oof_pred"))
