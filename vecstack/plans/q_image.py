"""Queries F1-F7 (image features) on ``embeddings`` read as 8×8 images.

The oracle is relational: pixels are unnested to ``(row_id, y, x, v)`` and each
Sobel output is a self-join of a pixel with its six weighted neighbours
(index clamping for ``reflect``, missing neighbours for ``constant``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vecstack.operators.image import Directional, Gradients, Hog, Zonal, image_features
from vecstack.plans.registry import EMB, big, long_sql, r, register, rnd
from vecstack.sources.tables import labelled_vectors

S = 8


def images(spark, sf, specs):
    return image_features(labelled_vectors(spark, sf).select("row_id", "features"), specs, side=S)


def _grad_cte(name: str, kernel: str, border: str) -> str:
    if border == "reflect":
        src = (f"s.y = least(greatest(t.y + k.dy, 0), {S - 1}) AND "
               f"s.x = least(greatest(t.x + k.dx, 0), {S - 1})")
    else:
        src = "s.y = t.y + k.dy AND s.x = t.x + k.dx"
    return f"""{name} AS (SELECT t.row_id, t.y, t.x, coalesce(sum(k.w * s.v), 0.0::DOUBLE) AS g
    FROM px t CROSS JOIN {kernel} k LEFT JOIN px s ON s.row_id = t.row_id AND {src}
    GROUP BY 1, 2, 3)"""


def grad_sql(border: str) -> str:
    """CTEs ``px`` (pixels) and ``g`` (row_id, y, x, gx, gy)."""
    return f"""
WITH e AS ({EMB}),
px AS (SELECT row_id, dim // {S} AS y, dim % {S} AS x, v FROM ({long_sql("SELECT * FROM e", "f", "row_id")})),
kx(dy, dx, w) AS (VALUES (-1, 1, 1.0::DOUBLE), (-1, -1, -1.0::DOUBLE), (0, 1, 2.0::DOUBLE),
                         (0, -1, -2.0::DOUBLE), (1, 1, 1.0::DOUBLE), (1, -1, -1.0::DOUBLE)),
ky(dy, dx, w) AS (VALUES (1, -1, 1.0::DOUBLE), (-1, -1, -1.0::DOUBLE), (1, 0, 2.0::DOUBLE),
                         (-1, 0, -2.0::DOUBLE), (1, 1, 1.0::DOUBLE), (-1, 1, -1.0::DOUBLE)),
{_grad_cte("gxt", "kx", border)},
{_grad_cte("gyt", "ky", border)},
g AS (SELECT gxt.row_id, gxt.y, gxt.x, gxt.g AS gx, gyt.g AS gy
      FROM gxt JOIN gyt ON gyt.row_id = gxt.row_id AND gyt.y = gxt.y AND gyt.x = gxt.x)"""


def hog_sql(cell: int, bins: int, signed: bool, border: str, raw: bool = False) -> str:
    """HOG rows ``(row_id, cell, bin, value)``; ``raw`` leaves the CTE ``hogv`` open and unrounded."""
    cells = S // cell
    if signed:
        b = f"floor(least(greatest(round((atan2(gy, gx) + pi()) * ({bins} / (2 * pi())), 9), 0), {bins - 1}))"
    else:
        ang = "((degrees(atan2(gy, gx)) % 180) + 180) % 180"
        b = f"least(greatest(floor(round({ang}, 9) / (180.0::DOUBLE / {bins})), 0), {bins - 1})"
    body = grad_sql(border) + f""",
o AS (SELECT row_id, (y // {cell}) * {cells} + (x // {cell}) AS cell, {b} AS bin,
             sqrt(gx * gx + gy * gy) AS mag FROM g WHERE y < {cells * cell} AND x < {cells * cell}),
grid AS (SELECT ids.row_id, c.cell, b.bin FROM (SELECT DISTINCT row_id FROM px) ids,
         (SELECT range AS cell FROM range({cells * cells})) c, (SELECT range AS bin FROM range({bins})) b),
hogv AS (SELECT grid.row_id, grid.cell, grid.bin, coalesce(sum(o.mag), 0) AS value
         FROM grid LEFT JOIN o ON o.row_id = grid.row_id AND o.cell = grid.cell AND o.bin = grid.bin
         GROUP BY 1, 2, 3)"""
    if raw:
        return body
    return body + f"""
SELECT row_id, cell::BIGINT AS cell, bin::BIGINT AS bin, {r("value")} AS value FROM hogv"""


def _hog_out(df, col, bins):
    out = df.select("row_id", F.posexplode(col).alias("d", "v"))
    return out.select("row_id", big(F.floor(F.col("d") / bins)).alias("cell"), big(F.col("d") % bins).alias("bin"),
                      rnd("v").alias("value"))


@register("sobel_gradients", f"""
WITH r AS ({grad_sql("reflect")} SELECT * FROM g),
c AS ({grad_sql("constant")} SELECT * FROM g)
SELECT r.row_id, (r.y * {S} + r.x)::BIGINT AS pos, {r("r.gx")} AS gx_reflect, {r("r.gy")} AS gy_reflect,
       {r("c.gx")} AS gx_constant, {r("c.gy")} AS gy_constant
FROM r JOIN c ON c.row_id = r.row_id AND c.y = r.y AND c.x = r.x""")
def q_sobel(spark, sf):
    df = images(spark, sf, [Gradients("reflect", "gr"), Gradients("constant", "gc")])
    z = df.select("row_id", F.posexplode(F.arrays_zip("gr_x", "gr_y", "gc_x", "gc_y")).alias("pos", "g"))
    return z.select("row_id", big("pos").alias("pos"), rnd("g.gr_x").alias("gx_reflect"),
                    rnd("g.gr_y").alias("gy_reflect"), rnd("g.gc_x").alias("gx_constant"),
                    rnd("g.gc_y").alias("gy_constant"))


@register("hog_signed_fine", hog_sql(4, 6, True, "reflect"))
def q_hog_fine(spark, sf):
    return _hog_out(images(spark, sf, [Hog(cell=4, bins=6, signed=True, border="reflect")]), "hog", 6)


@register("hog_unsigned", hog_sql(2, 8, False, "constant"))
def q_hog_unsigned(spark, sf):
    return _hog_out(images(spark, sf, [Hog(cell=2, bins=8, signed=False, border="constant")]), "hog", 8)


@register("hog_signed_coarse", hog_sql(2, 8, True, "reflect"))
def q_hog_coarse(spark, sf):
    return _hog_out(images(spark, sf, [Hog(cell=2, bins=8, signed=True, border="reflect")]), "hog", 8)


_DIR_SQL = grad_sql("reflect") + """,
en AS (SELECT row_id, sum(abs(gx)) AS e0, sum(abs(gy)) AS e1, sum(abs(gx + gy)) AS e2,
              sum(abs(gx - gy)) AS e3 FROM g GROUP BY row_id)"""


@register("directional6", _DIR_SQL + f"""
SELECT row_id, {r("e0")} AS e0, {r("e1")} AS e1, {r("e2")} AS e2, {r("e3")} AS e3,
       {r("e0 / (e1 + 1e-6)")} AS r0, {r("e2 / (e3 + 1e-6)")} AS r1 FROM en""")
def q_dir6(spark, sf):
    df = images(spark, sf, [Directional(ratios=True)])
    return df.select("row_id", *[rnd(F.col("dir")[i]).alias(n)
                                 for i, n in enumerate(["e0", "e1", "e2", "e3", "r0", "r1"])])


@register("directional4", _DIR_SQL + f"""
SELECT row_id, {r("e0")} AS e0, {r("e1")} AS e1, {r("e2")} AS e2, {r("e3")} AS e3 FROM en""")
def q_dir4(spark, sf):
    df = images(spark, sf, [Directional(ratios=False)])
    return df.select("row_id", *[rnd(F.col("dir")[i]).alias(n) for i, n in enumerate(["e0", "e1", "e2", "e3"])])


@register("zonal", f"""
WITH e AS ({EMB}),
px AS (SELECT row_id, dim // {S} AS y, dim % {S} AS x, v FROM ({long_sql("SELECT * FROM e", "f", "row_id")})),
blk AS (SELECT row_id, (y // 2) * 4 + (x // 2) AS dim, sum(v) AS value FROM px GROUP BY 1, 2),
rs AS (SELECT row_id, y, sum(v) AS s FROM px GROUP BY 1, 2),
cs AS (SELECT row_id, x, sum(v) AS s FROM px GROUP BY 1, 2),
st AS (SELECT row_id, 16 AS dim, avg(s) AS value FROM rs GROUP BY 1
       UNION ALL SELECT row_id, 17, stddev_pop(s) FROM rs GROUP BY 1
       UNION ALL SELECT row_id, 18, avg(s) FROM cs GROUP BY 1
       UNION ALL SELECT row_id, 19, stddev_pop(s) FROM cs GROUP BY 1)
SELECT row_id, dim::BIGINT AS dim, {r("value")} AS value FROM (SELECT * FROM blk UNION ALL SELECT * FROM st)""")
def q_zonal(spark, sf):
    df = images(spark, sf, [Zonal(grid=(4, 4))])
    out = df.select("row_id", F.posexplode("zon").alias("d", "v"))
    return out.select("row_id", big("d").alias("dim"), rnd("v").alias("value"))
