"""skyloom find PATH [--detection 8 --analysis 3 | --fdr 0.01 | --detection-image FILE] [--out FOLDER] [--maps NAMES --maps-out FOLDER], skyloom batch PATH --out FOLDER [--store FOLDER],
and skyloom stream HOST:PORT ... --landing FOLDER --store FOLDER --checkpoint FOLDER."""

from __future__ import annotations

import argparse


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="skyloom")
    sub = p.add_subparsers(dest="command", required=True)
    for name, about in (("find", "sources of each image, as CSV"), ("batch", "catalogue and variability of a set of images")):
        q = sub.add_parser(name, help=about)
        q.add_argument("path")
        q.add_argument("--detection", type=float, default=8.0)
        q.add_argument("--analysis", type=float, default=3.0)
        q.add_argument("--fdr", type=float)
        q.add_argument("--force-beam", action="store_true")
        q.add_argument("--bmaj", type=float, help="half axis of the beam in pixels, instead of the headers'")
        q.add_argument("--bmin", type=float)
        q.add_argument("--bpa", type=float, default=0.0)
        q.add_argument("--fixed", nargs="*", metavar="X,Y", help="fit at these pixels only")
        q.add_argument("--detection-image", help="an image whose islands all others are measured in")
        q.add_argument("--maps", nargs="*", default=[], metavar="NAME", help="gaussians, residual, rms, significance: FITS files of each image")
        q.add_argument("--maps-out", help="the folder of those")
        q.add_argument("--out")
        q.add_argument("--store", help="the folder of a catalogue to begin or go on with")
    q = sub.add_parser("stream", help="images from endpoints into a catalogue, time step by time step")
    q.add_argument("endpoints", nargs="+", metavar="HOST:PORT")
    q.add_argument("--landing", required=True, help="a shared folder for images that have come")
    q.add_argument("--store", required=True)
    q.add_argument("--checkpoint", required=True)
    q.add_argument("--detection", type=float, default=8.0)
    q.add_argument("--analysis", type=float, default=3.0)
    q.add_argument("--wait", type=float, default=60.0, help="seconds without an image after which an endpoint counts as ended")
    return p


def write_maps(maps, images, folder: str) -> None:
    """Each map as a FITS file NAME.MAP.fits in a folder, with its image's place on the sky."""
    from pyspark.sql import functions as F

    from skyloom.sources.fits_files import FitsImages

    maps.sparkSession.dataSource.register(FitsImages)
    keys = {"CRPIX1": "crpix1", "CRPIX2": "crpix2", "CRVAL1": "crval1", "CRVAL2": "crval2", "CDELT1": "deltax", "CDELT2": "deltay", "CROTA2": "crota2"}
    axes = (F.lit("CTYPE1"), F.concat(F.lit("RA---"), F.col("projection")), F.lit("CTYPE2"), F.concat(F.lit("DEC--"), F.col("projection")))
    header = F.map_filter(F.create_map(*axes, *(x for k, c in keys.items() for x in (F.lit(k), F.col(c).cast("string")))), lambda k, v: v.isNotNull())
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    named = maps.join(images.select("image", stem.alias("stem"), header.alias("header")), "image")
    named.select(F.concat_ws(".", "stem", "map", F.lit("fits")).alias("name"), "header", "nx", "ny", "pixels").write.format("fits_images").mode("append").save(folder)


def main(args: list[str] | None = None, spark=None) -> int:
    p = parser()
    a = p.parse_args(args)
    if a.command == "find" and bool(a.maps) != bool(a.maps_out):
        p.error("--maps and --maps-out go together")
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from skyloom.imaging import frames
    from skyloom.plans import batch
    from skyloom.plans.state import cut

    spark = spark or SparkSession.builder.appName("skyloom").getOrCreate()
    if a.command == "stream":
        from skyloom.streaming import landing, steps

        survey = batch.Survey(spark, a.store, detection=a.detection, analysis=a.analysis)
        receiving = landing.receive(spark, a.endpoints, a.landing, a.wait)
        query = steps.start(spark, a.landing, len(a.endpoints), survey, a.checkpoint)
        receiving.join()
        query.processAllAvailable()
        query.stop()
        return 0
    if a.command == "find":
        images = batch.images_of(spark, a.path)
        beam = (a.bmaj, a.bmin or a.bmaj, a.bpa) if a.bmaj else None
        if a.fixed:
            wanted = [(float(x), float(y)) for x, y in (q.split(",") for q in a.fixed)]
            requests = images.select("image").crossJoin(spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(wanted)], "n int, x double, y double"))  # a user's list
            out = frames.forced(images, requests, beam)
        elif a.detection_image:
            first = batch.images_of(spark, a.detection_image).withColumn("field", F.lit(1))
            found = frames.labels(first, beam, a.detection, a.analysis)
            out = frames.extract_in(images.withColumn("field", F.lit(1)), found, beam, a.detection, a.analysis, force_beam=a.force_beam)
        else:
            out = frames.extract(images, beam, a.detection, a.analysis, force_beam=a.force_beam, alpha=a.fdr)
        if a.maps:
            out = cut(out)
            write_maps(frames.result_maps(images, out, beam, tuple(a.maps)), images, a.maps_out)
        out = batch.on_sky(out, images, 0.0).select("image", "ra", "decl", "f_peak", "f_int")
    else:
        state, measured = batch.run(spark, a.path, a.store, detection=a.detection, analysis=a.analysis, force_beam=a.force_beam)
        out = batch.variability(state, measured)
    if a.out:
        out.write.mode("overwrite").option("header", True).csv(a.out)
    else:
        for row in out.toLocalIterator():
            print(*row, sep=", ")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
