"""Queries over surveys: quality of every image, detections on the sky, projections, stored catalogues, and DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions import clock, ephemeris
from skyloom.functions import geometry as g
from skyloom.imaging import frames
from skyloom.imaging import tiles as tiling
from skyloom.operators import association as a
from skyloom.operators import detections, discovery
from skyloom.operators import images as im
from skyloom.plans import catalogue as c
from skyloom.plans import fixtures as fx
from skyloom.plans import queries as q
from skyloom.plans.queries import r, rounded
from skyloom.plans.state import cut, shared_folder
from skyloom.sources import fits
from skyloom.sources.fits_files import FitsImages

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


# -- quality ------------------------------------------------------------------------------------------------------------


@query(f"""
WITH {q.IMAGES},
w AS (
  SELECT *, COUNT(rms_qc) OVER h AS n, AVG(rms_qc) OVER h AS mu, STDDEV_POP(rms_qc) OVER h AS sd
  FROM g WINDOW h AS (PARTITION BY band ORDER BY ts, image ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT image, band, n >= 10 AND NOT ABS(rms_qc - mu) < 1.5 * sd AS rejected FROM w
""")
def history_of_every_image(spark, sf_dir):
    """Each image against the last ten of its band as it comes."""
    return im.judged_by_history(q._images(spark, sf_dir), 10, 1.5).select("image", "band", "rejected")


# -- detections on the sky ------------------------------------------------------------------------------------------------


def _sin(x: str, y: str) -> str:
    """ra and decl of a pixel in the SIN projection about (ra0, d0), turned by rot degrees, steps of -0.01 and 0.01 degrees."""
    u = f"RADIANS(-0.01 * ({x} - 256) * COS(RADIANS(rot)) - 0.01 * ({y} - 256) * SIN(RADIANS(rot)))"
    v = f"RADIANS(-0.01 * ({x} - 256) * SIN(RADIANS(rot)) + 0.01 * ({y} - 256) * COS(RADIANS(rot)))"
    n = f"SQRT(1 - {u} * {u} - {v} * {v})"
    ra = f"ra0 + DEGREES(ATAN2({u}, {n} * COS(RADIANS(d0)) - {v} * SIN(RADIANS(d0))))"
    return f"{ra} AS ra, DEGREES(ASIN({v} * COS(RADIANS(d0)) + {n} * SIN(RADIANS(d0)))) AS decl"


FOUND = {
    "id": "p_partkey", "x": "100 + CAST(p_size AS DOUBLE) * 6", "y": "90 + CAST(p_partkey % 331 AS DOUBLE)", "x_err": "0.05 + CAST(p_partkey % 7 AS DOUBLE) / 10", "y_err": "0.04 + CAST(p_partkey % 5 AS DOUBLE) / 10",
    "major": "2 + CAST(p_size % 4 AS DOUBLE)", "minor": "1 + CAST(p_size % 2 AS DOUBLE) / 2", "theta": "CAST(p_partkey % 31 AS DOUBLE) / 10 - 1.5", "major_err": "0.1", "minor_err": "0.2",
    "ra0": "CAST(p_partkey % 360 AS DOUBLE)", "d0": "CAST(p_partkey % 141 AS DOUBLE) - 70", "rot": "CAST(p_partkey % 36 * 10 AS DOUBLE)",
}
#: The points around a detection, by number: along the errors, ends of both axes, corners of the error box.
POINTS = (
    (1, "x + east", "y"), (2, "x", "y + north_"), (3, "x - SIN(theta) * major", "y + COS(theta) * major"), (4, "x + COS(theta) * minor", "y + SIN(theta) * minor"),
    (5, "x + x_err", "y + y_err"), (6, "x - x_err", "y + y_err"), (7, "x + x_err", "y - y_err"), (8, "x - x_err", "y - y_err"),
)
APART = """DEGREES(2 * ASIN(SQRT((COS(RADIANS(p.decl)) * COS(RADIANS(p.ra)) - COS(RADIANS(n.decl)) * COS(RADIANS(n.ra))) ** 2
   + (COS(RADIANS(p.decl)) * SIN(RADIANS(p.ra)) - COS(RADIANS(n.decl)) * SIN(RADIANS(n.ra))) ** 2 + (SIN(RADIANS(p.decl)) - SIN(RADIANS(n.decl))) ** 2) / 2))"""


@query(f"""
WITH d AS (SELECT {", ".join(f"{v} AS {k}" for k, v in FOUND.items())} FROM part),
m AS (SELECT *, {_sin("x", "y")} FROM d),
s AS (SELECT id, {_sin("x", "(y + 0.5)")} FROM d),
n AS (
  SELECT m.*, DEGREES(ATAN2(SIN(RADIANS(s.ra - m.ra)) * COS(RADIANS(s.decl)),
    COS(RADIANS(m.decl)) * SIN(RADIANS(s.decl)) - SIN(RADIANS(m.decl)) * COS(RADIANS(s.decl)) * COS(RADIANS(s.ra - m.ra)))) AS north
  FROM m JOIN s USING (id)),
e AS (
  SELECT *, SQRT((x_err * COS(RADIANS(north))) ** 2 + (y_err * SIN(RADIANS(north))) ** 2) AS east,
    SQRT((x_err * SIN(RADIANS(north))) ** 2 + (y_err * COS(RADIANS(north))) ** 2) AS north_ FROM n),
p AS ({" UNION ALL ".join(f"SELECT id, {i} AS k, {_sin(f'({x})', f'({y})')} FROM e" for i, x, y in POINTS)}),
o AS (SELECT n.id, k, {APART} AS apart, ABS(p.ra - n.ra) AS turn, ABS(p.decl - n.decl) AS rise FROM p JOIN n USING (id)),
t AS (
  SELECT id, MAX(turn) FILTER (k < 3) AS ra_fit_err, MAX(rise) FILTER (k < 3) AS decl_fit_err, MAX(3600 * apart) FILTER (k > 4) AS error_radius,
    MAX(3600 * apart) FILTER (k = 3) AS semimajor, MAX(3600 * apart) FILTER (k = 4) AS semiminor FROM o GROUP BY id)
SELECT id, ROUND((ra + 360) % 360, 6) AS ra, ROUND(decl, 6) AS decl, ROUND(ra_fit_err, 6) AS ra_fit_err, ROUND(decl_fit_err, 6) AS decl_fit_err, ROUND(error_radius, 3) AS error_radius,
  ROUND(semimajor, 3) AS semimajor, ROUND(semiminor, 3) AS semiminor, ROUND(semimajor / major * major_err, 3) AS semimajor_err, ROUND(COS(RADIANS(DEGREES(theta) + north)) ** 2, 5) AS cos2_pa
FROM n JOIN t USING (id)
""")
def detections_on_sky(spark, sf_dir):
    """Detections at many places, rotations and declinations, their errors and axes on the sky."""
    # a part takes a few bytes of the file and ten projections: a split of the file is far too much for one task
    part = fx.read(spark, sf_dir, "part").select("p_partkey", "p_size").repartition(2 * spark.sparkContext.defaultParallelism)
    found = part.selectExpr(*(f"{v} AS {k}" for k, v in FOUND.items()))
    w = {"crpix1": F.lit(256.0), "crpix2": F.lit(256.0), "crval1": F.col("ra0"), "crval2": F.col("d0"), "cdelt1": F.lit(-0.01), "cdelt2": F.lit(0.01), "crota2": F.col("rot")}
    on = detections.on_sky(found, w)
    cos2 = F.pow(F.cos(F.radians("pa")), 2)
    return on.select("id", r("ra"), r("decl"), r("ra_fit_err"), r("decl_fit_err"), r("error_radius", 3), r("semimajor", 3), r("semiminor", 3), r("semimajor_err", 3), r(cos2, 5)).toDF("id", "ra", "decl", "ra_fit_err", "decl_fit_err", "error_radius", "semimajor", "semiminor", "semimajor_err", "cos2_pa")


# -- projections ------------------------------------------------------------------------------------------------------------

PROJECTED = f"""m AS ({q.M}), k AS (SELECT xtrsrc, ra, decl, xtrsrc % 6 AS k, RADIANS(ra - 140) AS a, RADIANS(decl) AS d, RADIANS(55) AS d0 FROM m),
 l AS (SELECT *, COS(d) * SIN(a) AS l, SIN(d) * COS(d0) - COS(d) * SIN(d0) * COS(a) AS m, SIN(d) * SIN(d0) + COS(d) * COS(d0) * COS(a) AS c FROM k),
 t AS (SELECT *, SQRT(l * l + m * m) AS s, ATAN2(SQRT(l * l + m * m), c) AS t FROM l WHERE c > 0.02 AND (k < 5 OR decl > 1))"""


@query(f"""
WITH {PROJECTED},
f AS (SELECT *, CASE k WHEN 0 THEN 1 WHEN 1 THEN 1 / c WHEN 2 THEN t / s WHEN 3 THEN 2 * TAN(t / 2) / s WHEN 4 THEN 2 * SIN(t / 2) / s ELSE 1 END AS f FROM t),
u AS (SELECT *, DEGREES(l * f) AS u, DEGREES(CASE WHEN k = 5 THEN (COS(d0) - COS(d) * COS(a)) / SIN(d0) ELSE m * f END) AS v FROM f)
SELECT xtrsrc, ROUND((u * COS(RADIANS(20)) + v * SIN(RADIANS(20))) / -0.5 + 128, 3) AS x, ROUND((v * COS(RADIANS(20)) - u * SIN(RADIANS(20))) / 0.5 + 128, 3) AS y, ROUND(ra, 5) AS ra, ROUND(decl, 5) AS decl FROM u
""")
def projections(spark, sf_dir):
    """Positions over a hemisphere (of NCP: north of the equator) to pixels and back, by six projections named in a column."""
    w = {"crpix1": F.lit(128.0), "crpix2": F.lit(128.0), "crval1": F.lit(140.0), "crval2": F.lit(55.0), "cdelt1": F.lit(-0.5), "cdelt2": F.lit(0.5), "crota2": F.lit(20.0)}
    name = F.element_at(F.array(*(F.lit(n) for n in g.PROJECTIONS)), (F.col("xtrsrc") % 6 + 1).cast("int"))
    near = F.cos(F.radians(g.distance_deg(F.col("ra"), F.col("decl"), F.lit(140.0), F.lit(55.0)))) > 0.02
    m = fx.measurements(spark, sf_dir).select("xtrsrc", "ra", "decl", name.alias("projection")).filter(near & ((F.col("projection") != "NCP") | (F.col("decl") > 1)))
    pixels = F.transform(F.array(F.struct("ra", "decl")), lambda p: F.struct(*(v.alias(n) for n, v in zip("xy", g.pixel_of_sky(p["ra"], p["decl"], w, F.col("projection")), strict=True))))
    back = F.transform("p", lambda p: F.struct(*(v.alias(n) for n, v in zip(("ra", "decl"), g.sky_of_pixel(p["x"], p["y"], w, F.col("projection")), strict=True))))
    return m.withColumn("p", pixels).withColumn("b", back).select("xtrsrc", r(F.col("p")[0]["x"], 3).alias("x"), r(F.col("p")[0]["y"], 3).alias("y"), r(F.col("b")[0]["ra"], 5).alias("ra"), r(F.col("b")[0]["decl"], 5).alias("decl"))


# -- bodies that move -------------------------------------------------------------------------------------------------------


def _orbit(name: str, e: tuple) -> str:
    """CTEs that put a body's place on the ecliptic at t into {name}(event_id, x, y, z)."""
    (a, da), (ecc, decc), (inc, dinc), (mean, dmean), (peri, dperi), (node, dnode) = e
    turns = "".join(f", {name}{i} AS (SELECT *, m + e * SIN(k{i - 1}) AS k{i} FROM {name}{i - 1})" for i in range(1, ephemeris.ROUNDS + 1))
    last = f"k{ephemeris.ROUNDS}"
    return f"""{name}_ AS (SELECT event_id, {a} + {da} * t AS a, {ecc} + {decc} * t AS e, RADIANS({inc} + {dinc} * t) AS i,
   RADIANS({mean} + {dmean} * t - ({peri} + {dperi} * t)) AS m, RADIANS({peri} + {dperi} * t - ({node} + {dnode} * t)) AS w, RADIANS({node} + {dnode} * t) AS o FROM d),
 {name}0 AS (SELECT *, m AS k0 FROM {name}_){turns},
 {name}p AS (SELECT *, a * (COS({last}) - e) AS p, a * SQRT(1 - e * e) * SIN({last}) AS q FROM {name}{ephemeris.ROUNDS}),
 {name}r AS (SELECT *, COS(w) * p - SIN(w) * q AS l, SIN(w) * p + COS(w) * q AS c FROM {name}p),
 {name} AS (SELECT event_id, COS(o) * l - SIN(o) * COS(i) * c AS x, SIN(o) * l + COS(o) * COS(i) * c AS y, SIN(i) * c AS z FROM {name}r)"""


def _seen(x: str, y: str, z: str, name: str) -> str:
    u, v = f"(COS(RADIANS(23.4392911)) * ({y}) - SIN(RADIANS(23.4392911)) * ({z}))", f"(SIN(RADIANS(23.4392911)) * ({y}) + COS(RADIANS(23.4392911)) * ({z}))"
    ra = f"DEGREES(ATAN2({u}, {x}))"
    return f"{ra} - 360 * FLOOR({ra} / 360) AS {name}_ra, DEGREES(ATAN2({v}, SQRT(({x}) * ({x}) + {u} * {u}))) AS {name}_decl"


@query(f"""
WITH d AS (SELECT event_id, ts, user_id, (EPOCH_US(ts) / 86400e6 + 40587 - 51544.5) / 36525 AS t FROM events),
{_orbit("earth", ephemeris.EARTH)},
{_orbit("jove", ephemeris.JUPITER)},
n AS (
  SELECT event_id, t, RADIANS(125.04452 - 1934.136261 * t) AS o, RADIANS(280.4665 + 36000.7698 * t) AS s, RADIANS(218.3165 + 481267.8813 * t) AS m FROM d),
f AS (
  SELECT *, -17.20 * SIN(o) - 1.32 * SIN(2 * s) - 0.23 * SIN(2 * m) + 0.21 * SIN(2 * o) AS psi,
    23.4392911 - 0.0130042 * t + (9.20 * COS(o) + 0.57 * COS(2 * s) + 0.10 * COS(2 * m) - 0.09 * COS(2 * o)) / 3600 AS eps,
    280.46061837 + 360.98564736629 * t * 36525 + 0.000387933 * t * t - t * t * t / 38710000 + 6.869837 AS mean FROM n),
g AS (SELECT event_id, mean + psi * COS(RADIANS(eps)) / 3600 AS lst FROM f),
b AS (
  SELECT event_id, {_seen("-e.x", "-e.y", "-e.z", "sun")}, {_seen("j.x - e.x", "j.y - e.y", "j.z - e.z", "jupiter")} FROM earth e JOIN jove j USING (event_id))
SELECT event_id, ROUND(sun_ra, 5) AS sun_ra, ROUND(sun_decl, 5) AS sun_decl, ROUND(jupiter_ra, 5) AS jupiter_ra, ROUND(jupiter_decl, 5) AS jupiter_decl, ROUND((lst - 360 * FLOOR(lst / 360)) * 240, 2) AS lst_seconds
FROM b JOIN g USING (event_id)
""")
def sun_jupiter_sidereal(spark, sf_dir):
    """Where the Sun and Jupiter stood at each event, and the local apparent sidereal time."""
    day = clock.mjd(F.col("ts"))
    e = fx.read(spark, sf_dir, "events").select("event_id", ephemeris.sun(day).alias("sun"), ephemeris.jupiter(day).alias("jupiter"), r(ephemeris.apparent_sidereal_seconds(day), 2).alias("lst_seconds"))
    return e.select("event_id", *(r(f"{name}.{axis}", 5).alias(f"{name}_{axis}") for name in ("sun", "jupiter") for axis in ("ra", "decl")), "lst_seconds")


# -- stored catalogues ----------------------------------------------------------------------------------------------------


@query(q.ORACLE_SQL["association_loop"])
def association_resumed(spark, sf_dir):
    """All weeks, each taken by a run of its own that finds the catalogue as the one before committed it; compacted on the way."""
    m = cut(q._means(fx.measurements(spark, sf_dir), "source", F.floor(F.datediff("day", F.lit("2024-01-01").cast("date")) / 7).alias("week")))
    root = f"{shared_folder(spark)}/resumed-{uuid.uuid4()}"
    for week in sorted(w for (w,) in m.select("week").distinct().collect()):  # weeks of a survey
        store = c.Catalogue(spark, root, every=3)
        before = store.state().settled()
        store.commit(c.state_changes(before, a.associate(before, q.by_dataset(m.filter(F.col("week") == week).drop("week")), q.RADIUS)))
    state = c.Catalogue(spark, root).state()
    both = state.runcat.join(state.flux.select("runcat", "f_datapoints", "avg_f_int"), "runcat")
    return rounded(both.select("runcat", "datapoints", "wm_ra", "wm_decl", "f_datapoints", "avg_f_int"), wm_ra=6, wm_decl=6, avg_f_int=6)


@query(q.ORACLE_SQL["region_memberships"])
def memberships_of_later_fields(spark, sf_dir):
    """Half of the fields first; then each source meets the fields that come later, and links are appended once."""
    spots, regions = q._spots(spark, sf_dir), fx.skyregions(spark, sf_dir)
    known = im.get_or_create_regions(regions.filter("skyrgn < 12"), regions.filter("skyrgn < 12"))
    later = regions.join(known.select("skyrgn"), "skyrgn", "left_anti")
    links = a.memberships(spots, known).unionByName(a.memberships(spots, later))
    return rounded(links.select("runcat", F.col("skyrgn").cast("long"), "distance_deg"), distance_deg=6)


# -- discovery ----------------------------------------------------------------------------------------------------------------

TAIL = "EXP(-z * z / 2) / SQRT(2 * PI()) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))"


@query(f"""
WITH v AS (SELECT vec_id, UNNEST(embedding) AS e FROM embeddings WHERE embedding IS NOT NULL),
z AS (SELECT vec_id % 10 AS image, ROUND(CAST(e AS DOUBLE) * 10, 3) AS z FROM v),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY image ORDER BY z DESC) AS k, COUNT(*) OVER (PARTITION BY image) AS n, 1 / (1 + 0.2316419 * ABS(z)) AS t FROM z WHERE z IS NOT NULL),
p AS (SELECT *, CASE WHEN z >= 0 THEN {TAIL} ELSE 1 - {TAIL} END AS p FROM k WHERE k <= GREATEST(1, n // 2))
SELECT image, ROUND(MIN(z), 3) AS threshold, CAST(MAX(k) AS BIGINT) AS accepted FROM p WHERE p < 0.05 * k / (n * (1 + 1 / 2.0 + 1 / 3.0 + 1 / 4.0)) GROUP BY image
""")
def fdr_over_pixels(spark, sf_dir):
    """Threshold of ten images made of all vectors' values, four pixels correlated."""
    v = fx.read(spark, sf_dir, "embeddings").filter("embedding IS NOT NULL").select((F.col("vec_id") % 10).alias("image"), F.explode("embedding").alias("e"))
    pixels: DataFrame = v.select("image", r(F.col("e").cast("double") * 10, 3).alias("snr"))
    return discovery.fdr_threshold(pixels, 0.05, 4.0).select("image", r("threshold", 3).alias("threshold"), "accepted")


# -- islands over tiles -----------------------------------------------------------------------------------------------------


def vector_images(spark, sf_dir) -> DataFrame:
    """Images of 100 by 64 whole numbers, a hundred vectors each; vectors that are not there are zeros."""
    v = fx.read(spark, sf_dir, "embeddings").filter("size(embedding) = 64")
    row = F.transform("embedding", lambda e: F.round(e.cast("double") * 100))
    rows = v.groupBy(F.floor(F.col("vec_id") / 100).alias("image")).agg(F.map_from_entries(F.collect_list(F.struct((F.col("vec_id") % 100).cast("int"), row))).alias("m"))  # a hundred at most
    empty = F.array_repeat(F.lit(0.0), 64)
    pixels = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(99)), lambda x: F.coalesce(F.try_element_at("m", x), empty)))
    return rows.select("image", F.lit(100).alias("nx"), F.lit(64).alias("ny"), pixels.alias("pixels"))


@query("""
WITH RECURSIVE p AS (
  SELECT vec_id // 100 AS image, vec_id % 100 AS x, UNNEST(RANGE(64)) AS y, UNNEST(embedding) AS e FROM embeddings WHERE len(embedding) = 64),
v AS (SELECT image, x, y, x * 64 + y AS k, ROUND(CAST(e AS DOUBLE) * 100) AS v FROM p WHERE ROUND(CAST(e AS DOUBLE) * 100) > 18),
r AS (
  SELECT image, k AS root, x, y FROM v
  UNION SELECT r.image, r.root, v.x, v.y FROM r JOIN v ON v.image = r.image AND ABS(v.x - r.x) + ABS(v.y - r.y) = 1),
i AS (SELECT image, x, y, MIN(root) AS island FROM r GROUP BY image, x, y)
SELECT image, island, CAST(COUNT(*) AS BIGINT) AS n, SUM(v) AS total, MAX(v) AS peak FROM i JOIN v USING (image, x, y) GROUP BY image, island HAVING MAX(v) >= 25
""")
def islands_over_tiles(spark, sf_dir):
    """A hundred vectors make an image of whole numbers, cut into tiles of sixteen pixels; islands go over their borders."""
    return tiling.islands(vector_images(spark, sf_dir), 25, 18, 16, grid=False)


@query("""
WITH RECURSIVE p AS (
  SELECT vec_id // 100 AS image, vec_id % 100 AS x, UNNEST(RANGE(64)) AS y, UNNEST(embedding) AS e FROM embeddings WHERE len(embedding) = 64),
a AS (SELECT image, x, y, x * 64 + y AS k, ROUND(CAST(e AS DOUBLE) * 100) AS v FROM p),
v AS (SELECT * FROM a WHERE v > 18),
r AS (
  SELECT image, k AS root, x, y FROM v
  UNION SELECT r.image, r.root, v.x, v.y FROM r JOIN v ON v.image = r.image AND ABS(v.x - r.x) + ABS(v.y - r.y) = 1),
i AS (SELECT image, x, y, MIN(root) AS island FROM r GROUP BY image, x, y),
d AS (SELECT image, island FROM i JOIN v USING (image, x, y) GROUP BY image, island HAVING MAX(v) >= 25),
c AS (SELECT image, island, x * 64 + y AS k FROM i JOIN d USING (image, island)),
m AS (SELECT image, (image // 2) * 2 AS field FROM a GROUP BY image)
SELECT m.image, CAST(island AS INTEGER) AS island, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(COALESCE(a.v, 0)) AS BIGINT) AS total, CAST(MAX(COALESCE(a.v, 0)) AS BIGINT) AS peak
FROM m JOIN c ON c.image = m.field LEFT JOIN a ON a.image = m.image AND a.k = c.k GROUP BY m.image, island
""")
def fluxes_in_detected_islands(spark, sf_dir):
    """Each two images are a field; the first is its detection image, and both are measured in the islands found on that."""
    images = vector_images(spark, sf_dir).withColumn("field", F.floor(F.col("image") / 2) * 2)
    found = frames.labels(images.filter("image = field"), (1.0, 1.0, 0.0), 25, 18, grid=False)
    return frames.sums_in(images, found).selectExpr("image", "island", "n", "CAST(total AS BIGINT) AS total", "CAST(peak AS BIGINT) AS peak")


# -- files ----------------------------------------------------------------------------------------------------------------------


@query("""
WITH p AS (SELECT vec_id // 100 AS image, vec_id % 100 AS x, UNNEST(RANGE(64)) AS y, UNNEST(embedding) AS e FROM embeddings WHERE len(embedding) = 64),
v AS (SELECT image, x * 64 + y AS k, ROUND(CAST(e AS DOUBLE) * 100) AS v FROM p)
SELECT image, CAST(image * 1.5 AS DOUBLE) AS weight, 'no. ' || image AS object, SUM(v) AS total, SUM(v * k) AS moment, MAX(v) AS peak FROM v GROUP BY image
""")
def fits_files(spark, sf_dir):
    """Images written as FITS files and read again, each file by the source in a task."""
    spark.dataSource.register(FitsImages)
    folder = f"{shared_folder(spark)}/fits-{uuid.uuid4()}"
    cards = F.create_map(F.lit("WEIGHT"), (F.col("image") * 1.5).cast("string"), F.lit("OBJECT"), F.concat(F.lit("no. "), F.col("image").cast("string")))
    named = vector_images(spark, sf_dir).select(F.format_string("%d.fits", "image").alias("name"), cards.alias("header"), "nx", "ny", "pixels")
    named.write.format("fits_images").mode("append").save(folder)
    back = spark.read.format("fits_images").load(folder)
    image = F.regexp_extract("path", r"(\d+)\.fits$", 1).cast("long")
    sums = F.aggregate(F.transform("pixels", lambda v, k: v * k), F.lit(0.0), lambda a, v: a + v)
    return back.select(image.alias("image"), fits.number(F.col("header"), "WEIGHT").alias("weight"), fits.text(F.col("header"), "OBJECT").alias("object"), F.aggregate("pixels", F.lit(0.0), lambda a, v: a + v).alias("total"), sums.alias("moment"), F.array_max("pixels").alias("peak"))
