"""Association of an image's measurements with the running catalogue.

candidates -> prune -> classify are plain DataFrame functions; `associate` applies a whole image to a State, returning
the next State. Images follow each other in time; within one everything is joins and windows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions import geometry as g
from skyloom.functions import statistics as st
from skyloom.operators.zone_join import zone_join
from skyloom.plans.schemas import schema
from skyloom.plans.state import cut, cut_all, empty

DE_RUITER = 5.68
FLUXES = ("f_peak", "f_int")
MEANS = tuple(n.format(f) for f in FLUXES for n in ("avg_{}", "avg_{}_sq", "avg_{}_weight", "avg_weighted_{}", "avg_weighted_{}_sq"))


# Columns are made once and used for every image: making them costs a call into the JVM each, which is what a small step's
# time would go into.


@cache
def _position(ra: str, decl: str, prefix: str) -> dict[str, Column]:
    x, y, z = g.cartesian(F.col(ra), F.col(decl))
    return {f"{prefix}zone": g.zone(F.col(decl)), f"{prefix}x": x, f"{prefix}y": y, f"{prefix}z": z}


def with_position(df: DataFrame, ra: str, decl: str, prefix: str = "") -> DataFrame:
    return df.withColumns(_position(ra, decl, prefix))


def crosses_meridian(centre_ra: Column, centre_decl: Column, radius: Column) -> Column:
    """Whether a field reaches across right ascension 0."""
    a = g.alpha_inflate(radius, centre_decl)
    return (centre_ra - a < 0) | (centre_ra + a > 360)


def candidates(measured: DataFrame, catalogue: DataFrame, radius: float, de_ruiter: float = DE_RUITER, across: bool = False) -> DataFrame:
    """Edges between measurements(xtrsrc, ra, decl, uew, uns, ...) and catalogue(runcat, wm_*, avg_*, datapoints).

    Within the radius (a declination strip, a box in right ascension unless the field crosses the meridian, a cone) and
    below the De Ruiter radius; where both sides have a dataset, within that. Each edge has its distance, r and the position
    averages that it would lead to.
    """
    near = with_position(measured, "ra", "decl", "m_")
    far = with_position(catalogue, "wm_ra", "wm_decl", "c_")
    test, r, distance = _near(radius, de_ruiter, across)
    if "dataset" in measured.columns and "dataset" in catalogue.columns:
        far, test = far.withColumnRenamed("dataset", "c_dataset"), test & (F.col("dataset") == F.col("c_dataset"))
    edges = zone_join(near, far, "decl", radius, "c_zone", test)
    return moved(edges.withColumns({"r": r, "distance_arcsec": distance}), across).drop("m_zone", "m_x", "m_y", "m_z", "c_zone", "c_x", "c_y", "c_z", "c_dataset")


#: Rows of one place that a block holds, and pairs of a part that `unfolded` makes.
BLOCK, PAIRS = 1024, 4 << 20


def blocks(rows: DataFrame, key: str) -> DataFrame:
    """Rows that agree in all but key as one for about BLOCK of them, with their keys as an array. A null agrees with nothing."""
    by = [c for c in rows.columns if c != key]
    sizes = rows.groupBy(*by).agg(F.count("*").alias("__n"))
    dealt = rows.join(sizes, by).withColumn("__block", F.pmod(F.xxhash64(key), F.ceil(F.col("__n") / BLOCK)))
    return dealt.groupBy(*by, "__block").agg(F.collect_list(key).alias(key)).drop("__block")


def unfolded(edges: DataFrame) -> DataFrame:
    """Edges between blocks as edges between their rows, made in parts of about PAIRS, however few the places are."""
    edges = cut(edges)
    total = edges.agg(F.sum(F.size("runcat").cast("long") * F.size("xtrsrc"))).first()[0] or 0
    rows = edges.repartition(max(1, -(-total // PAIRS), min(total >> 16, edges.sparkSession.sparkContext.defaultParallelism)))
    return rows.withColumn("xtrsrc", F.explode("xtrsrc")).withColumn("runcat", F.explode("runcat"))


@cache
def _near(radius: float, de_ruiter: float, across: bool) -> tuple[Column, Column, Column]:
    """Whether a pair is near enough, its De Ruiter radius, and its distance in arcseconds."""
    box = F.abs(F.col("wm_decl") - F.col("decl")) <= radius
    if not across:
        reach = g.alpha_inflate(F.lit(radius), F.col("decl"))
        box = box & F.col("wm_ra").between(F.col("ra") - reach, F.col("ra") + reach)
    dot = F.col("m_x") * F.col("c_x") + F.col("m_y") * F.col("c_y") + F.col("m_z") * F.col("c_z")
    cone = dot > F.cos(F.radians(F.lit(radius)))
    r = g.de_ruiter(g.ra_difference(F.col("ra"), F.col("wm_ra"), across), F.col("decl"), F.col("wm_decl"), F.col("uew"), F.col("wm_uew"), F.col("uns"), F.col("wm_uns"))
    return box & cone & (r < de_ruiter), r, 3600 * g.chord_deg(F.col("m_x") - F.col("c_x"), F.col("m_y") - F.col("c_y"), F.col("m_z") - F.col("c_z"))


def moved(edges: DataFrame, across: bool = False) -> DataFrame:
    """new_* columns: position averages with the measurement added."""
    return edges.withColumns(_moved(across))


@cache
def _moved(across: bool) -> dict[str, Column]:
    n = F.col("datapoints")
    w, v = st.weight(F.col("uew")), st.weight(F.col("uns"))
    wra, wde = n * F.col("avg_weight_ra") + w, n * F.col("avg_weight_decl") + v
    if across:
        turned = (n * F.col("avg_weight_ra") * g.wrapped(F.col("wm_ra")) + w * g.wrapped(F.col("ra"))) / wra - 180
        ra = F.when((turned < 0) & (turned > -st.FLOOR), 0.0).when(turned < 0, turned + 360).otherwise(turned)
        avg_wra = ra * wra / (n + 1)
    else:
        ra = (n * F.col("avg_wra") + F.col("ra") * w) / wra
        avg_wra = st.grown(n, F.col("avg_wra"), F.col("ra") * w)
    return {
        "new_wm_ra": ra, "new_wm_decl": (n * F.col("avg_wdecl") + F.col("decl") * v) / wde, "new_wm_uew": F.sqrt(1 / wra), "new_wm_uns": F.sqrt(1 / wde),
        "new_avg_wra": avg_wra, "new_avg_wdecl": st.grown(n, F.col("avg_wdecl"), F.col("decl") * v), "new_avg_weight_ra": wra / (n + 1), "new_avg_weight_decl": wde / (n + 1),
    }


def prune(edges: DataFrame) -> DataFrame:
    """edges with `kept`: among edges whose both ends have others, only a measurement's nearest ones stay."""
    flagged = edges.selectExpr("*", "COUNT(*) OVER (PARTITION BY runcat) > 1 AND COUNT(*) OVER (PARTITION BY xtrsrc) > 1 AS __many")
    return flagged.selectExpr("*", "NOT __many OR r <= MIN(CASE WHEN __many THEN r END) OVER (PARTITION BY xtrsrc) AS kept").drop("__many")


def classify(edges: DataFrame) -> DataFrame:
    """Kept edges with their association type: 2 where the source forks over several measurements, else 3."""
    return edges.filter("kept").drop("kept").selectExpr("*", "CASE WHEN COUNT(*) OVER (PARTITION BY runcat) > 1 THEN 2 ELSE 3 END AS type")


def unmatched(measured: DataFrame, edges: DataFrame) -> DataFrame:
    """Measurements without any edge, pruned ones included."""
    return measured.join(edges.select("xtrsrc"), "xtrsrc", "left_anti")


@dataclass(frozen=True)
class State:
    """The catalogue: sources, their fluxes by band, associations, field memberships and new-source events."""

    runcat: DataFrame
    flux: DataFrame
    assoc: DataFrame
    skyrgn: DataFrame
    newsource: DataFrame

    @classmethod
    def new(cls, spark: SparkSession) -> State:
        return cls(empty(spark, "runningcatalog"), empty(spark, "runningcatalog_flux"), empty(spark, "assocxtrsource"), empty(spark, "assocskyrgn"), empty(spark, "newsource"))

    def settled(self, *names: str) -> State:
        """With the lineage of the named tables cut, or of all."""
        names = names or TABLES
        return replace(self, **dict(zip(names, cut_all(*(getattr(self, k) for k in names)), strict=True)))


TABLES = ("runcat", "flux", "assoc", "skyrgn", "newsource")


@cache
def _grown() -> dict[str, Column]:
    out = {}
    for f in FLUXES:
        x, w = F.col(f), st.weight(F.col(f"{f}_err"))
        for name, value in ((f"avg_{f}", x), (f"avg_{f}_sq", x * x), (f"avg_{f}_weight", w), (f"avg_weighted_{f}", w * x), (f"avg_weighted_{f}_sq", w * x * x)):
            out[name] = st.grown(F.col("__n"), F.col(f"__{name}"), value)
    out["f_datapoints"] = (F.coalesce("__n", F.lit(0)) + 1).cast("long")
    return out


def flux_after(edges: DataFrame, flux: DataFrame) -> DataFrame:
    """edges(runcat, band, stokes, f_*) with the flux averages that they lead to, and f_datapoints."""
    old = flux.selectExpr("runcat", "band", "stokes", "f_datapoints AS __n", *(f"{c} AS __{c}" for c in MEANS))
    return edges.join(old, ["runcat", "band", "stokes"], "left").withColumns(_grown()).drop("__n", *(f"__{c}" for c in MEANS))


@cache
def _first() -> dict[str, Column]:
    out = {}
    for f in FLUXES:
        x, w = F.col(f), st.weight(F.col(f"{f}_err"))
        out |= {f"avg_{f}": x, f"avg_{f}_sq": x * x, f"avg_{f}_weight": w, f"avg_weighted_{f}": w * x, f"avg_weighted_{f}_sq": w * x * x}
    return out | {"f_datapoints": F.lit(1).cast("long")}


def flux_of_first(measured: DataFrame) -> DataFrame:
    """measured(runcat, band, stokes, f_*) with the averages of one measurement."""
    return measured.withColumns(_first())


@cache
def _metrics() -> dict[str, Column]:
    n = F.col("f_datapoints")
    return {"v_int": st.v_int(n, F.col("avg_f_int"), F.col("avg_f_int_sq")), "eta_int": st.eta_int(n, F.col("avg_f_int_weight"), F.col("avg_weighted_f_int"), F.col("avg_weighted_f_int_sq"))}


def metrics(df: DataFrame) -> DataFrame:
    return df.withColumns(_metrics())


def _sources(edges: DataFrame, key: str) -> DataFrame:
    """Catalogue rows from edges that a measurement extends."""
    rows = edges.selectExpr(f"{key} AS runcat", "dataset", "datapoints + 1 AS datapoints", *(f"new_{c} AS {c}" for c in ("wm_ra", "wm_decl", "wm_uew", "wm_uns", "avg_wra", "avg_wdecl", "avg_weight_ra", "avg_weight_decl")), "false AS mon_src", "0L AS forcedfits_count")
    return with_position(rows, "wm_ra", "wm_decl")


def _of_dataset(measured: DataFrame, dataset: int) -> DataFrame:
    return measured if "dataset" in measured.columns else measured.withColumn("dataset", F.lit(dataset).cast("long"))


@cache
def _weights() -> dict[str, Column]:
    return {"__w": st.weight(F.col("uew")), "__v": st.weight(F.col("uns"))}


def _founded(measured: DataFrame, dataset: int, mon_src: bool = False) -> DataFrame:
    rows = _of_dataset(measured, dataset).withColumns(_weights()).selectExpr(
        "xtrsrc AS runcat", "dataset", "1L AS datapoints", "ra AS wm_ra", "decl AS wm_decl", "uew AS wm_uew", "uns AS wm_uns", "ra * __w AS avg_wra", "decl * __v AS avg_wdecl", "__w AS avg_weight_ra", "__v AS avg_weight_decl", f"{mon_src} AS mon_src", "0L AS forcedfits_count"
    )
    return with_position(rows, "wm_ra", "wm_decl")


@cache
def _casts(name: str) -> tuple[str, ...]:
    return tuple(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema(name))


def _as(df: DataFrame, name: str) -> DataFrame:
    """df as rows of the table of that name."""
    return df.selectExpr(*_casts(name))


def union(first: DataFrame, *more: DataFrame | None) -> DataFrame:
    for df in more:
        first = first if df is None else first.unionByName(df)
    return first


def fork_count(kept: DataFrame) -> int:
    """How many edges fork. A measurement can found one source only; two forks from the same one are an error in the data, not a choice."""
    forks, most = kept.filter("type = 2").groupBy("xtrsrc").count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.max("count")).first()
    if most and most > 1:
        twice = kept.filter("type = 2").groupBy("xtrsrc").count().filter("count > 1").first()[0]
        raise ValueError(f"measurement {twice} would found more than one source")
    return forks


def associate(state: State, measured: DataFrame, radius: float, de_ruiter: float = DE_RUITER, dataset: int = 1, across: bool = False, skyrgn: int | None = None, regions: DataFrame | None = None, limits: DataFrame | None = None) -> State:
    """The state after one image's blind measurements (xtrsrc, band, stokes, ra, decl, uew, uns, f_peak, f_int and errors).

    skyrgn is the image's field; regions(skyrgn, centre_ra, centre_decl, xtr_radius) are all fields of the dataset. limits
    (image, skyrgn, low, high), if given, are earlier good images of the band with their flux limits: a source that is not
    matched is new if the most sensitive of those that cover one of its fields should have shown it.

    A column dataset of measured, if there is one, stands for the argument: surveys of the same sky that are taken together
    and never link with each other.
    """
    measured = cut(_of_dataset(measured, dataset))
    active = state.runcat.filter("NOT mon_src")
    edges = cut(prune(candidates(measured, active.drop("zone", "x", "y", "z"), radius, de_ruiter, across)))
    fresh = unmatched(measured, edges)
    kept, first = cut_all(metrics(flux_after(classify(edges), state.flux)), metrics(flux_of_first(fresh.selectExpr("*", "xtrsrc AS runcat"))))
    fresh = first.select(measured.columns)
    forks, plain = kept.filter("type = 2") if fork_count(kept) else None, kept.filter("type = 3")  # a source has one edge of type 3

    runcat = union(state.runcat.join(kept.select("runcat"), "runcat", "left_anti"), _as(_sources(plain, "runcat"), "runningcatalog"), _as(_founded(fresh, dataset), "runningcatalog"))
    flux = state.flux.join(plain.select("runcat", "band", "stokes"), ["runcat", "band", "stokes"], "left_anti").select(state.flux.columns)
    flux = union(flux, _as(plain, "runningcatalog_flux"), _as(first, "runningcatalog_flux"))
    founders = first.selectExpr("*", "4 AS type", "0D AS distance_arcsec", "0D AS r")
    assoc = union(state.assoc, _as(plain, "assocxtrsource"), _as(founders.withColumns({"v_int": F.lit(0.0), "eta_int": F.lit(0.0)}), "assocxtrsource"))
    links, events = state.skyrgn, state.newsource
    changed = ["runcat", "flux", "assoc"]

    if forks is not None:
        # forks take the history of the source with them, as type 6; bands other than this image's are not carried in flux
        forked = forks.select("runcat").distinct()
        named, new = forks.selectExpr("runcat AS old", "xtrsrc AS new"), forks.withColumn("runcat", F.col("xtrsrc"))
        retired = lambda df: df.join(forked, "runcat", "left_anti")
        renamed = lambda df: df.join(named, df["runcat"] == named["old"]).withColumn("runcat", F.col("new"))
        runcat = union(runcat, _as(_sources(forks, "xtrsrc"), "runningcatalog"))
        flux = union(retired(flux), _as(new, "runningcatalog_flux"))
        assoc = union(retired(assoc), _as(renamed(state.assoc).withColumn("type", F.lit(6)), "assocxtrsource"), _as(new, "assocxtrsource"))
        links, events = union(retired(links), _as(renamed(links), "assocskyrgn")), union(retired(events), _as(renamed(events), "newsource"))
        changed = list(TABLES)

    if skyrgn is not None:
        links = union(links, _as(fresh.selectExpr("xtrsrc AS runcat", f"{skyrgn}L AS skyrgn", "CAST(NULL AS DOUBLE) AS distance_deg"), "assocskyrgn"))
        changed += ["skyrgn"] * ("skyrgn" not in changed)
        if regions is not None:
            links = union(links, _as(memberships(fresh.selectExpr("xtrsrc AS runcat", "ra", "decl"), regions.filter(F.col("skyrgn") != skyrgn)), "assocskyrgn"))
    after = State(runcat, flux, assoc, links, events).settled(*changed)
    if skyrgn is not None and limits is not None:
        fields = after.skyrgn.join(fresh.selectExpr("xtrsrc AS runcat"), "runcat", "left_semi").selectExpr("runcat AS xtrsrc", "skyrgn")
        covered = fresh.select("xtrsrc", "f_peak").join(fields, "xtrsrc").join(limits, "skyrgn")
        after = replace(after, newsource=union(after.newsource, _as(new_sources(best_limits(covered)), "newsource"))).settled("newsource")
    return after


@cache
def _apart() -> Column:
    return g.chord_deg(F.col("s_x") - F.col("c_x"), F.col("s_y") - F.col("c_y"), F.col("s_z") - F.col("c_z"))


def memberships(sources: DataFrame, regions: DataFrame) -> DataFrame:
    """runcat, skyrgn, distance_deg of sources(runcat, ra, decl) within a region's radius."""
    far = with_position(sources, "ra", "decl", "s_")
    near = with_position(regions, "centre_ra", "centre_decl", "c_")
    return zone_join(near, far, "centre_decl", "xtr_radius", "s_zone", _apart() < F.col("xtr_radius"), ra="centre_ra", far_ra="ra").select("runcat", "skyrgn", _apart().alias("distance_deg"))


def new_sources(unmatched: DataFrame) -> DataFrame:
    """Events of measurements that an earlier image (image, low, high) should have shown: type 1 beyond doubt, 0 maybe."""
    return unmatched.filter("f_peak > low").selectExpr("xtrsrc AS runcat", "xtrsrc AS trigger_xtrsrc", "image AS previous_limits_image", "CASE WHEN f_peak > high THEN 1 ELSE 0 END AS newsource_type")


def best_limits(pairs: DataFrame) -> DataFrame:
    """Of pairs (xtrsrc, image, low, high), each measurement's most sensitive earlier image."""
    return pairs.selectExpr("*", "ROW_NUMBER() OVER (PARTITION BY xtrsrc ORDER BY low, high, image) AS __n").filter("__n = 1").drop("__n")


def null_detections(sources: DataFrame, seen: DataFrame, links: DataFrame, skyrgn: int, expiration: int = 10, founded: DataFrame | None = None, ts=None) -> DataFrame:
    """Sources linked to the field that this image (seen: its runcats) did not show, unless forced fits have expired.

    founded(runcat, ts) are times of the sources' first measurements: only those before this image's ts count, so that a
    source found in another band of the same time step is not asked for.
    """
    if founded is not None:
        sources = sources.join(founded.filter(F.col("ts") < F.lit(ts)).select("runcat"), "runcat", "left_semi")
    return sources.filter(f"forcedfits_count < {expiration} AND NOT mon_src").join(links.filter(f"skyrgn = {skyrgn}"), "runcat", "left_semi").join(seen, "runcat", "left_anti").select("runcat", "wm_ra", "wm_decl")


def associate_forced(state: State, fits: DataFrame) -> State:
    """The state after forced fits (runcat, xtrsrc, band, stokes, fluxes) of null detections: type 7, fluxes only."""
    rows = cut(metrics(flux_after(fits.join(state.runcat.select("runcat"), "runcat", "left_semi"), state.flux)))
    flux = union(state.flux.join(rows.select("runcat", "band", "stokes"), ["runcat", "band", "stokes"], "left_anti").select(state.flux.columns), _as(rows, "runningcatalog_flux"))
    assoc = union(state.assoc, _as(rows.selectExpr("*", "7 AS type", "0D AS distance_arcsec", "0D AS r"), "assocxtrsource"))
    hit = rows.selectExpr("runcat", "1 AS __hit").distinct()
    runcat = state.runcat.join(hit, "runcat", "left").withColumn("forcedfits_count", F.expr("forcedfits_count + COALESCE(__hit, 0)")).select(state.runcat.columns)
    return replace(state, runcat=runcat, flux=flux, assoc=assoc).settled("runcat", "flux", "assoc")


def linked_back(monitors: DataFrame, fits: DataFrame) -> DataFrame:
    """monitors(id, runcat, ...) with the source that the first fit (ff_monitor, xtrsrc) of each founded."""
    new = fits.groupBy(F.col("ff_monitor").alias("id")).agg(F.min("xtrsrc").alias("__new"))
    return monitors.join(new, "id", "left").withColumn("runcat", F.coalesce("runcat", "__new")).select(monitors.columns)


def inconsistencies(rows: DataFrame, key: str, image: str, zone: str | None = None) -> DataFrame:
    """problem, n: rows whose id, image, or all of id, image and zone are 0; a sound table has none of each."""
    tests = {"id": F.col(key) == 0, "image": F.col(image) == 0, "all": (F.col(key) == 0) & (F.col(image) == 0) & (F.lit(True) if zone is None else F.col(zone) == 0)}
    counts = rows.agg(*(F.count_if(t).alias(n) for n, t in tests.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(n).alias("problem"), F.col(n).alias("n")) for n in tests))).alias("x")).select("x.*")


def associate_monitored(state: State, fits: DataFrame, dataset: int = 1, skyrgn: int | None = None) -> State:
    """The state after fits (runcat or null, xtrsrc, ra, decl, ...) at monitored positions: types 8 and 9. New sources belong to the field."""
    fits = cut(fits)
    old, fresh = fits.filter("runcat IS NOT NULL"), fits.filter("runcat IS NULL").withColumn("runcat", F.col("xtrsrc"))
    rows = cut(metrics(flux_after(old.withColumn("type", F.lit(9)).unionByName(fresh.withColumn("type", F.lit(8))), state.flux)))
    flux = union(state.flux.join(rows.select("runcat", "band", "stokes"), ["runcat", "band", "stokes"], "left_anti").select(state.flux.columns), _as(rows, "runningcatalog_flux"))
    assoc = union(state.assoc, _as(rows.selectExpr("*", "0D AS distance_arcsec", "0D AS r"), "assocxtrsource"))
    hit = old.groupBy("runcat").agg(F.count("*").alias("__hit"))
    runcat = state.runcat.join(hit, "runcat", "left").withColumn("datapoints", F.expr("datapoints + COALESCE(__hit, 0)")).select(state.runcat.columns)
    after = replace(state, runcat=union(runcat, _as(_founded(fresh, dataset, True), "runningcatalog")), flux=flux, assoc=assoc)
    if skyrgn is None:
        return after.settled("runcat", "flux", "assoc")
    own = fresh.selectExpr("runcat", f"{skyrgn}L AS skyrgn", "CAST(NULL AS DOUBLE) AS distance_deg")
    return replace(after, skyrgn=union(state.skyrgn, _as(own, "assocskyrgn"))).settled("runcat", "flux", "assoc", "skyrgn")
