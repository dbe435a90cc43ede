"""Queries A3, A4, M5-M12, J6, U1 (trees, forests, boosting).

Oracle: a generated level-wise SQL growth (``grow_sql``) with the same rules —
stopping (depth, min split, purity, 2·min leaf), candidates = distinct
interpolated percentiles (rows repeated by their bootstrap multiplicity),
weighted Gini gain, min leaf on both sides, ties by (gain, feature, threshold),
majority ties by first row.  Values and thresholds are compared at 9 decimals
on both engines (``decimals=9``).
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Window
from pyspark.sql import functions as F

from vecstack.functions.hashing import sql_hash
from vecstack.operators import boosting as B
from vecstack.operators import evaluate as ev
from vecstack.operators import trees as T
from vecstack.plans.registry import EMB, LINEITEM_LABEL, big, long_sql, r, register, rnd
from vecstack.sources.tables import LINEITEM_FEATURES, labelled_vectors, lineitem_vectors

DEC = 9
# The reference's settings: a tree of depth 8; 25 trees of depth 8 on 35 % of the rows; 25 rounds of depth-5 trees.
TREE_P = T.TreeParams(max_depth=8, min_samples_split=20, min_samples_leaf=5, max_features=None,
                      n_thresholds=16, decimals=DEC)
FOREST_P = T.TreeParams(max_depth=8, min_samples_split=20, min_samples_leaf=5, max_features="sqrt",
                        n_thresholds=20, decimals=DEC)
TREES = 25
BOOST = dict(n_estimators=25, lr=0.25, max_depth=5, min_samples_split=10, min_samples_leaf=5, n_thresholds=10,
             subsample_rate=0.6, max_features="sqrt", decimals=DEC)


def _binned(p: T.TreeParams) -> T.TreeParams:
    """The same settings with the candidates of a feature found once (histogram engine)."""
    return dataclasses.replace(p, thresholds="hist")


def _fr(q):
    return "[" + ", ".join("%.17e" % f for f in T.quantile_fractions(q)) + "]::DOUBLE[]"


def grow_sql(base: str, xl: str, depth: int, q: int, min_split: int, min_leaf: int, p: str = "t",
             sqrt_features: bool = False, once: bool = False) -> str:
    """CTEs (each preceded by a comma) ending in ``{p}_nodes(tree, node, is_leaf, feature,
    threshold, pred, n, depth)``; ``base(tree, row_id, label, w)``, ``xl(row_id, dim, v)``.
    With ``sqrt_features`` each open node searches the floor(√d) features of smallest hash
    (``{p}_cf{L}``), and gain ties are broken by that hash rank.  With ``once`` the candidates of a feature
    are its percentiles over all of ``{xl}``, at every node."""
    s = [f"""{p}_gt AS (SELECT DISTINCT dim, unnest(list_transform(quantile_cont(v, {_fr(q)}), lambda z: round(z, {DEC}))) AS t FROM {xl} GROUP BY dim)""",
         f"{p}_a0 AS (SELECT tree, row_id, label, w, 1 AS node FROM {base})",
         f"{p}_dd AS (SELECT max(dim) + 1 AS d FROM {xl})"]
    h = sql_hash("'42:feat:' || tree::VARCHAR || ':' || node::VARCHAR || ':' || dim::VARCHAR")
    for L in range(depth + 1):
        if sqrt_features:
            cf = f"""{p}_cf{L} AS (SELECT tree, node, dim, frank FROM (
                  SELECT tree, node, dim, row_number() OVER (PARTITION BY tree, node ORDER BY {h}, dim) AS frank
                  FROM (SELECT o.tree, o.node, unnest(range(dd.d)) AS dim FROM {p}_o{L} o, {p}_dd dd))
                  WHERE frank <= (SELECT floor(sqrt(d)) FROM {p}_dd)),"""
            wjoin = f"JOIN {p}_cf{L} c ON c.tree = a.tree AND c.node = a.node AND c.dim = x.dim"
            rank = f"(SELECT frank FROM {p}_cf{L} c WHERE c.tree = g.tree AND c.node = g.node AND c.dim = g.dim)"
        else:
            cf, wjoin, rank = "", "", "g.dim + 1"
        cand = ("""{p}_th{L} AS (SELECT DISTINCT tree, node, dim, t FROM {p}_w{L} JOIN {p}_gt USING (dim)),""" if once else
                f"""{{p}}_rep{{L}} AS (SELECT tree, node, dim, v, unnest(range(w)) AS _i FROM {{p}}_w{{L}}),
{{p}}_q{{L}} AS (SELECT tree, node, dim, list_transform(quantile_cont(v, {_fr(q)}), lambda z: round(z, {DEC})) AS qs
             FROM {{p}}_rep{{L}} GROUP BY 1, 2, 3),
{{p}}_th{{L}} AS (SELECT DISTINCT tree, node, dim, unnest(qs) AS t FROM {{p}}_q{{L}}),""")
        s.append(f"""{p}_s{L} AS (SELECT tree, node, label, sum(w) AS cnt, min(row_id) AS first FROM {p}_a{L} GROUP BY 1, 2, 3),
{p}_n{L} AS (SELECT tree, node, sum(cnt) AS n, count(*) FILTER (WHERE cnt > 0) AS k FROM {p}_s{L} GROUP BY 1, 2),
{p}_m{L} AS (SELECT tree, node, label AS pred FROM {p}_s{L}
             QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY cnt DESC, first) = 1),
{p}_o{L} AS (SELECT tree, node FROM {p}_n{L}
             WHERE {L} < {depth} AND n >= {min_split} AND k > 1 AND n >= {2 * min_leaf}),
{cf}
{p}_w{L} AS (SELECT a.tree, a.node, a.label, a.w, x.dim, x.v FROM {p}_a{L} a JOIN {p}_o{L} o USING (tree, node)
             JOIN {xl} x ON x.row_id = a.row_id {wjoin}),
{cand.format(p=p, L=L)}
{p}_lc{L} AS (SELECT th.tree, th.node, th.dim, th.t, x.label, sum(x.w) AS lk FROM {p}_th{L} th
              JOIN {p}_w{L} x ON x.tree = th.tree AND x.node = th.node AND x.dim = th.dim AND x.v <= th.t
              GROUP BY 1, 2, 3, 4, 5),
{p}_f{L} AS (SELECT th.tree, th.node, th.dim, th.t, s.cnt AS pk, coalesce(lc.lk, 0) AS lk FROM {p}_th{L} th
             JOIN {p}_s{L} s ON s.tree = th.tree AND s.node = th.node
             LEFT JOIN {p}_lc{L} lc ON lc.tree = th.tree AND lc.node = th.node AND lc.dim = th.dim
                                   AND lc.t = th.t AND lc.label = s.label),
{p}_g{L} AS (SELECT tree, node, dim, t, sum(lk)::DOUBLE AS nl, sum(pk - lk)::DOUBLE AS nr,
                    sum(lk * lk)::DOUBLE AS sl, sum((pk - lk) * (pk - lk))::DOUBLE AS sr,
                    sum(pk * pk)::DOUBLE AS sp FROM {p}_f{L} GROUP BY 1, 2, 3, 4),
{p}_gg{L} AS (SELECT *, round((1 - sp / ((nl + nr) * (nl + nr)))
                     - nl / (nl + nr) * (CASE WHEN nl > 0 THEN 1 - sl / (nl * nl) ELSE 0 END)
                     - nr / (nl + nr) * (CASE WHEN nr > 0 THEN 1 - sr / (nr * nr) ELSE 0 END), 12) AS gain
              FROM {p}_g{L} WHERE nl >= {min_leaf} AND nr >= {min_leaf}),
{p}_gr{L} AS (SELECT g.*, {rank} AS frank FROM {p}_gg{L} g),
{p}_b{L} AS (SELECT tree, node, dim AS feature, t AS threshold FROM {p}_gr{L} WHERE gain > 1e-12
             QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, frank, t) = 1),
{p}_nd{L} AS (SELECT n.tree, n.node, b.feature IS NULL AS is_leaf, coalesce(b.feature, -1) AS feature,
                     b.threshold, m.pred, n.n, {L} AS depth
              FROM {p}_n{L} n JOIN {p}_m{L} m USING (tree, node) LEFT JOIN {p}_b{L} b USING (tree, node)),
{p}_a{L + 1} AS (SELECT a.tree, a.row_id, a.label, a.w, a.node * 2 + (x.v > b.threshold)::INTEGER AS node
                 FROM {p}_a{L} a JOIN {p}_b{L} b USING (tree, node)
                 JOIN {xl} x ON x.row_id = a.row_id AND x.dim = b.feature)""")
    s.append(f"{p}_nodes AS (" + " UNION ALL ".join(f"SELECT * FROM {p}_nd{L}" for L in range(depth + 1)) + ")")
    return ",\n" + ",\n".join(s)


def apply_sql(nodes: str, rows: str, xl: str, depth: int, p: str = "ap") -> str:
    """CTEs ending in ``{p}_leaf(row_id, tree, node, vote)``."""
    s = [f"{p}_p0 AS (SELECT r.row_id, t.tree, 1 AS node FROM {rows} r, (SELECT DISTINCT tree FROM {nodes}) t)"]
    for L in range(depth):
        s.append(f"""{p}_p{L + 1} AS (SELECT q.row_id, q.tree, CASE WHEN nd.is_leaf THEN q.node
                     ELSE q.node * 2 + (x.v > nd.threshold)::INTEGER END AS node
              FROM {p}_p{L} q JOIN {nodes} nd ON nd.tree = q.tree AND nd.node = q.node
              LEFT JOIN {xl} x ON x.row_id = q.row_id AND x.dim = nd.feature)""")
    s.append(f"""{p}_leaf AS (SELECT q.row_id, q.tree, q.node, nd.pred AS vote FROM {p}_p{depth} q
                 JOIN {nodes} nd ON nd.tree = q.tree AND nd.node = q.node)""")
    return ",\n" + ",\n".join(s)


def nodes_select(n: str) -> str:
    return (f"SELECT tree::BIGINT AS tree, node::BIGINT AS node, is_leaf::BIGINT AS is_leaf, "
            f"feature::BIGINT AS feature, {r('threshold')} AS threshold, pred::BIGINT AS pred, "
            f"n::BIGINT AS n, depth::BIGINT AS depth FROM {n}")


def nodes_out(ens: T.TreeEnsemble, spark):
    t = ens.nodes_frame(spark)
    return t.select(big("tree").alias("tree"), big("node").alias("node"), big(F.col("is_leaf").cast("int")).alias("is_leaf"),
                    big("feature").alias("feature"),
                    F.when(F.col("is_leaf"), F.lit(None).cast("double")).otherwise(rnd("threshold")).alias("threshold"),
                    big("pred").alias("pred"), big("n").alias("n"), big("depth").alias("depth"))


_HEAD = f"""WITH RECURSIVE e AS ({EMB}),
tr AS (SELECT * FROM e),
va AS (SELECT * FROM e),
xl AS (SELECT row_id, dim, round(v, {DEC}) AS v FROM ({long_sql("SELECT * FROM e", "f", "row_id")}))"""


def split(spark, sf):
    """Fit rows and scored rows: the whole table is both."""
    df = labelled_vectors(spark, sf)
    return df, df


# A3 ------------------------------------------------------------------------
_LI_LONG = " UNION ALL ".join(f"SELECT {i} AS dim, round({c}, {DEC}) AS v FROM lineitem"
                              for i, c in enumerate(LINEITEM_FEATURES))


@register("split_candidates", f"""
WITH l AS ({_LI_LONG}),
q AS (SELECT dim, list_transform(quantile_cont(v, {_fr(16)}), lambda z: round(z, {DEC})) AS qs FROM l GROUP BY dim)
SELECT DISTINCT dim::BIGINT AS feature, {r("t")} AS threshold FROM (SELECT dim, unnest(qs) AS t FROM q)""")
def q_split_candidates(spark, sf):
    c = T.split_candidates(lineitem_vectors(spark, sf), T.TreeParams(n_thresholds=16, decimals=DEC))
    return c.select(big("feature").alias("feature"), rnd("threshold").alias("threshold")).distinct()


# A4 ------------------------------------------------------------------------
@register("best_split", _HEAD + ",\nbase AS (SELECT 0 AS tree, row_id, label, 1 AS w FROM tr)"
          + grow_sql("base", "xl", 1, 16, 20, 5) + f"""
SELECT dim::BIGINT AS feature, {r("t")} AS threshold, nl::BIGINT AS n_left, {r("gain", 9)} AS gain FROM t_gg0
QUALIFY row_number() OVER (PARTITION BY dim ORDER BY gain DESC, t) = 1""")
def q_best_split(spark, sf):
    tr, _ = split(spark, sf)
    g = T.root_split_table(tr, TREE_P)
    w = Window.partitionBy("feature").orderBy(F.col("gain").desc(), F.col("t"))
    b = g.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
    return b.select(big("feature").alias("feature"), rnd("t").alias("threshold"), big("nl").alias("n_left"),
                    rnd("gain", 9).alias("gain"))


_OFF_HALF = 2e-13          # gains have 12 decimals: keeps the cut to 9 from meeting a half, which engines round differently
_LI_CLASSES = " UNION ALL ".join(f"SELECT {i} AS dim, round({c}, {DEC}) AS v, {LINEITEM_LABEL} AS label FROM lineitem"
                                 for i, c in enumerate(LINEITEM_FEATURES))


@register("split_every_value", f"""
WITH l AS ({_LI_CLASSES}),
c AS (SELECT dim, v, label, count(*)::DOUBLE AS n FROM l GROUP BY ALL),
k AS (SELECT DISTINCT label FROM l),
g AS (SELECT d.dim, d.v, k.label, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT dim, v FROM l) d CROSS JOIN k LEFT JOIN c USING (dim, v, label)),
w AS (SELECT dim, v, sum(n) OVER (PARTITION BY dim, label ORDER BY v) AS le, sum(n) OVER (PARTITION BY dim, label) AS al FROM g),
a AS (SELECT dim, v, sum(le) AS nl, sum(al - le) AS nr, sum(le * le) AS sl, sum((al - le) * (al - le)) AS sr, sum(al * al) AS sp FROM w GROUP BY ALL)
SELECT dim::BIGINT AS feature, {r("v")} AS threshold, nl::BIGINT AS n_left, nr::BIGINT AS n_right,
       {r("round((1 - sp / ((nl + nr) * (nl + nr))) - nl / (nl + nr) * (1 - sl / (nl * nl)) - nr / (nl + nr) * (1 - sr / (nr * nr)), 12) + 2e-13", 9)} AS gain
FROM a WHERE nl >= 5 AND nr >= 5""")
def q_split_every_value(spark, sf):
    """Every distinct value of every measure as a cut, with the rows and the gain of its two sides."""
    g = T.root_split_table(lineitem_vectors(spark, sf), T.TreeParams(n_thresholds=0, max_features=None, decimals=DEC))
    return g.select(big("feature").alias("feature"), rnd("t").alias("threshold"), big("nl").alias("n_left"), big("nr").alias("n_right"),
                    rnd(F.col("gain") + _OFF_HALF, 9).alias("gain"))


# M5 / M6 ---------------------------------------------------------------------
_TREE_BASE = _HEAD + ",\nbase AS (SELECT 0 AS tree, row_id, label, 1 AS w FROM tr)"
_TREE_SQL = _TREE_BASE + grow_sql("base", "xl", TREE_P.max_depth, 16, 20, 5)


def _tree(spark, sf):
    tr, va = split(spark, sf)
    return T.fit_tree(tr, TREE_P), va


@register("tree_fit", _TREE_SQL + "\n" + nodes_select("t_nodes"))
def q_tree_fit(spark, sf):
    ens, _ = _tree(spark, sf)
    return nodes_out(ens, spark)


@register("tree_fit_hist", _TREE_BASE + grow_sql("base", "xl", TREE_P.max_depth, 16, 20, 5, once=True) + "\n" + nodes_select("t_nodes"))
def q_tree_fit_hist(spark, sf):
    """M5 by the histogram engine: all features at every node, the larger sibling by subtraction."""
    return nodes_out(T.fit_tree(labelled_vectors(spark, sf), _binned(TREE_P)), spark)


@register("tree_predict", _TREE_SQL + apply_sql("t_nodes", "va", "xl", TREE_P.max_depth) + """
SELECT row_id, node::BIGINT AS node, vote::BIGINT AS pred FROM ap_leaf""")
def q_tree_predict(spark, sf):
    ens, va = _tree(spark, sf)
    v = ens.apply(va)
    return v.select("row_id", big("node").alias("node"), big("vote").alias("pred"))


# M7 / M8 / U1 / J6 -------------------------------------------------------------
_FOREST_BASE = _HEAD + f""",
lam AS (SELECT greatest(1000, floor(0.35::DOUBLE * count(*)))::DOUBLE / count(*) AS lam FROM tr),
cdf(k, p, c) AS (SELECT 0, exp(-lam), exp(-lam) FROM lam
                 UNION ALL SELECT k + 1, p * (lam / (k + 1)), c + p * (lam / (k + 1)) FROM cdf, lam
                 WHERE NOT (c >= 1 - 1e-15 OR k + 1 > 10 * lam + 50)),
u AS (SELECT tt.range AS tree, tr.row_id, tr.label,
             {sql_hash("'42:boot:' || tt.range::VARCHAR || ':' || tr.row_id::VARCHAR")} / 4294967296.0::DOUBLE AS u
      FROM tr, range({TREES}) tt),
base AS (SELECT tree, row_id, label, w FROM (SELECT u.tree, u.row_id, u.label, count(cdf.c) AS w
         FROM u LEFT JOIN cdf ON cdf.c <= u.u GROUP BY 1, 2, 3) WHERE w > 0)"""
_FOREST_SQL = _FOREST_BASE + grow_sql("base", "xl", FOREST_P.max_depth, 20, 20, 5, sqrt_features=True)


def _forest(spark, sf, params=FOREST_P):
    tr, va = split(spark, sf)
    ens = T.fit_forest(tr, n_estimators=TREES, sample_ratio=0.35, bootstrap=True, min_rows=1000, params=params)
    return ens, tr, va


@register("forest_fit", _FOREST_SQL + "\n" + nodes_select("t_nodes"))
def q_forest_fit(spark, sf):
    ens, _, _ = _forest(spark, sf)
    return nodes_out(ens, spark)


@register("forest_fit_hist", _FOREST_BASE + grow_sql("base", "xl", FOREST_P.max_depth, 20, 20, 5, sqrt_features=True, once=True) + "\n" + nodes_select("t_nodes"))
def q_forest_fit_hist(spark, sf):
    """M7 by the histogram engine."""
    ens, _, _ = _forest(spark, sf, _binned(FOREST_P))
    return nodes_out(ens, spark)


@register("stack_votes", _FOREST_SQL + apply_sql("t_nodes", "va", "xl", FOREST_P.max_depth) + """
SELECT row_id, tree::BIGINT AS tree, vote::BIGINT AS vote FROM ap_leaf""")
def q_stack_votes(spark, sf):
    ens, _, va = _forest(spark, sf)
    return ens.apply(va).select("row_id", big("tree").alias("tree"), big("vote").alias("vote"))


@register("forest_predict", _FOREST_SQL + apply_sql("t_nodes", "va", "xl", FOREST_P.max_depth) + """,
vv AS (SELECT row_id, vote, count(*) AS c, min(tree) AS first FROM ap_leaf GROUP BY 1, 2)
SELECT row_id, vote::BIGINT AS pred FROM vv
QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY c DESC, first) = 1""")
def q_forest_predict(spark, sf):
    ens, _, va = _forest(spark, sf)
    return ens.predict(va).select("row_id", big("pred").alias("pred"))


@register("pipeline_reloaded", _FOREST_SQL + apply_sql("t_nodes", "va", "xl", FOREST_P.max_depth) + """,
vv AS (SELECT row_id, vote, count(*) AS c, min(tree) AS first FROM ap_leaf GROUP BY 1, 2)
SELECT row_id, vote::BIGINT AS pred FROM vv
QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY c DESC, first) = 1""")
def q_pipeline_reloaded(spark, sf):
    """A pipeline with a forest is fitted, saved, read back and applied."""
    from pyspark.ml import Pipeline, PipelineModel

    from vecstack.operators.stages import ForestStage
    from vecstack.sources.files import scratch_path
    df, _ = split(spark, sf)
    forest = ForestStage(n_estimators=TREES, sample_ratio=0.35, max_depth=FOREST_P.max_depth, n_thresholds=FOREST_P.n_thresholds, decimals=DEC)
    path = scratch_path(spark, "pipeline")
    Pipeline(stages=[forest]).fit(df).write().overwrite().save(path)
    return PipelineModel.load(path).transform(df).select("row_id", big("pred").alias("pred"))


@register("model_apply_join", _FOREST_SQL + apply_sql("t_nodes", "e", "xl", FOREST_P.max_depth) + """
SELECT row_id, tree::BIGINT AS tree, node::BIGINT AS node FROM ap_leaf""")
def q_model_apply(spark, sf):
    ens, _, _ = _forest(spark, sf)
    return ens.apply(labelled_vectors(spark, sf)).select("row_id", big("tree").alias("tree"), big("node").alias("node"))


# R5 ------------------------------------------------------------------------
@register("feature_subset", _FOREST_SQL + """
SELECT tree::BIGINT AS tree, node::BIGINT AS node, dim::BIGINT AS feature, frank::BIGINT AS frank FROM (
""" + " UNION ALL ".join(f"SELECT * FROM t_cf{L}" for L in range(FOREST_P.max_depth + 1)) + ")")
def q_feature_subset(spark, sf):
    """The √d candidate features (hash rank per node) of every node the forest searched."""
    ens, tr, _ = _forest(spark, sf)
    d = tr.agg(F.max(F.size("features"))).first()[0]
    fs = ens.searched_features(spark, d)
    return fs.select(big("tree").alias("tree"), big("node").alias("node"), big("feature").alias("feature"),
                     big("frank").alias("frank"))


# M9 ------------------------------------------------------------------------
@register("forest_proba")
def q_forest_proba(spark, sf):
    """Rows-only: library random forest probabilities (Spark ML) of every row."""
    tr, va = split(spark, sf)
    classes = ev.distinct_labels(tr)
    m = B.fit_rf_proba(tr, seed=42)                 # 250 trees of depth 30
    out = B.rf_predict_proba(m, va, classes)
    return out.select("row_id", big("pred").alias("pred"), rnd(F.array_max("proba")).alias("p_max"))


# M10 / M11 -----------------------------------------------------------------
_BOOST_BASE = _HEAD + f""",
cl AS (SELECT label AS c, (dense_rank() OVER (ORDER BY label) - 1) AS k FROM (SELECT DISTINCT label FROM tr)),
nk AS (SELECT count(*) AS nk FROM cl),
ntr AS (SELECT count(*) AS n FROM tr),
sub AS (SELECT rd.range AS round, tr.row_id, tr.label FROM tr, range({BOOST["n_estimators"]}) rd
        QUALIFY row_number() OVER (PARTITION BY rd.range ORDER BY
          {sql_hash("'42:sub:' || rd.range::VARCHAR || ':' || tr.row_id::VARCHAR")}, tr.row_id)
          <= (SELECT floor({BOOST["subsample_rate"]}::DOUBLE * n) FROM ntr)),
bw AS (SELECT sub.round * nk.nk + cl.k AS tree, sub.row_id, (sub.label = cl.c)::INTEGER AS label, 1 AS w
       FROM sub, cl, nk),
ok AS (SELECT tree FROM bw GROUP BY tree HAVING count(DISTINCT label) = 2),
base AS (SELECT bw.* FROM bw JOIN ok USING (tree))"""
_BOOST_GROW = dict(base="base", xl="xl", depth=BOOST["max_depth"], q=BOOST["n_thresholds"], min_split=BOOST["min_samples_split"],
                   min_leaf=BOOST["min_samples_leaf"], sqrt_features=True)
_BOOST_SQL = _BOOST_BASE + grow_sql(**_BOOST_GROW)


def _boost(spark, sf, thresholds="exact"):
    tr, va = split(spark, sf)
    return B.fit_boosting(tr, seed=42, thresholds=thresholds, **BOOST), va


@register("boost_fit", _BOOST_SQL + "\n" + nodes_select("t_nodes"))
def q_boost_fit(spark, sf):
    m, _ = _boost(spark, sf)
    return nodes_out(m.ensemble, spark)


@register("boost_fit_hist", _BOOST_BASE + grow_sql(**_BOOST_GROW, once=True) + "\n" + nodes_select("t_nodes"))
def q_boost_fit_hist(spark, sf):
    """M10 by the histogram engine: every (round, class) tree grown together."""
    m, _ = _boost(spark, sf, "hist")
    return nodes_out(m.ensemble, spark)


@register("boost_proba", _BOOST_SQL + apply_sql("t_nodes", "va", "xl", BOOST["max_depth"]) + f""",
sc AS (SELECT row_id, tree % (SELECT nk FROM nk) AS k, sum(vote) AS v FROM ap_leaf GROUP BY 1, 2),
grid AS (SELECT va.row_id, cl.k, {BOOST["lr"]}::DOUBLE * coalesce(sc.v, 0) AS s FROM va CROSS JOIN cl
         LEFT JOIN sc ON sc.row_id = va.row_id AND sc.k = cl.k),
mx AS (SELECT row_id, max(s) AS m FROM grid GROUP BY 1),
ex AS (SELECT grid.row_id, grid.k, exp(grid.s - mx.m) AS e FROM grid JOIN mx USING (row_id)),
se AS (SELECT row_id, sum(e) AS se FROM ex GROUP BY 1),
pp AS (SELECT ex.row_id, ex.k, ex.e / (se.se + 1e-12) AS p FROM ex JOIN se USING (row_id)),
pr AS (SELECT row_id, k AS pk FROM pp QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY p DESC, k) = 1)
SELECT pp.row_id, cl.c::BIGINT AS cls, {r("pp.p", 9)} AS p, c2.c::BIGINT AS pred
FROM pp JOIN cl ON cl.k = pp.k JOIN pr USING (row_id) JOIN cl c2 ON c2.k = pr.pk""")
def q_boost_proba(spark, sf):
    m, va = _boost(spark, sf)
    out = m.predict_proba(va)
    cls = F.array(*[F.lit(int(c)) for c in m.classes])
    z = out.select("row_id", "pred", F.posexplode("proba").alias("i", "p"))
    return z.select("row_id", big(F.element_at(cls, F.col("i") + 1)).alias("cls"), rnd("p", 9).alias("p"),
                    big("pred").alias("pred"))


# M12 -----------------------------------------------------------------------
@register("gbt_multiclass")
def q_gbt(spark, sf):
    """Rows-only: one-vs-rest Spark ML GBT, softmax over raw margins."""
    tr, va = split(spark, sf)
    m = B.fit_gbt_ovr(tr)                           # 250 rounds of depth-4 trees for each class
    out = m.predict_proba(va)
    return out.select("row_id", big("pred").alias("pred"), rnd(F.array_max("proba")).alias("p_max"))
