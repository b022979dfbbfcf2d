"""FITS images without external readers: header cards, image data, and a DataFrame over files.

A row has the header as a map and the pixels in row-major [x][y] order; metadata columns are expressions on the map.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions import geometry as g

BLOCK, CARD = 2880, 80
DTYPES = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
TEXT = re.compile(r"\s*'((?:[^']|'')*)'")
#: What a card holds without quotes: numbers and logical values.
BARE = re.compile(r"[-+]?(\d+\.?\d*|\.\d+)([ED][-+]?\d+)?|[TF]", re.I)
SCHEMA = "path string, header map<string,string>, history string, nx int, ny int, pixels array<double>"


def parse_header(raw: bytes) -> tuple[dict[str, str], str, int]:
    """Cards as text, HISTORY joined by lines, and where the data begin."""
    header, history, at, last = {}, [], 0, None
    while at + CARD <= len(raw):
        card = raw[at : at + CARD].decode("ascii", "replace")
        at += CARD
        name = card[:8].strip()
        if name == "END":
            break
        if name == "HISTORY":
            history.append(card[8:].strip())
        elif name == "CONTINUE" and last and header[last].endswith("&"):
            more = TEXT.match(card[8:])
            header[last] = header[last][:-1] + (more[1].replace("''", "'").rstrip() if more else "")
        elif card[8:10] == "= ":
            text = TEXT.match(card[10:])
            last = name
            header[name] = text[1].replace("''", "'").rstrip() if text else card[10:].split("/")[0].strip()
    else:
        raise ValueError("no END card")
    return header, "\n".join(history), -(-at // BLOCK) * BLOCK


def parse(raw: bytes, plane: int = 0) -> tuple[dict[str, str], str, np.ndarray]:
    """Header, history and one plane of the image, indexed [x, y]."""
    if not raw.startswith(b"SIMPLE"):
        raise ValueError("not a FITS file")
    header, history, at = parse_header(raw)
    axes = [int(header[f"NAXIS{i}"]) for i in range(1, int(header["NAXIS"]) + 1)]
    if len(axes) < 2:
        raise ValueError("an image needs two axes")
    kind = np.dtype(DTYPES[int(header["BITPIX"])])
    size = axes[0] * axes[1]
    data = np.frombuffer(raw, kind, size, at + plane * size * kind.itemsize).reshape(axes[1], axes[0]).T.astype(float)
    return header, history, data * float(header.get("BSCALE", 1)) + float(header.get("BZERO", 0))


def _card(name: str, value) -> bytes:
    """A value's cards: numbers and logical values bare, also those written as text; text too long for one goes on in CONTINUE cards."""
    if isinstance(value, bool):
        text = f"{'T' if value else 'F':>20}"
    elif isinstance(value, int | float | np.number):
        text = f"{value!r:>20}" if not isinstance(value, np.number) else f"{value.item()!r:>20}"
    elif BARE.fullmatch(str(value)) and len(str(value)) <= CARD - 10:
        text = f"{value:>20}"
    else:
        quoted = str(value).encode("ascii", "replace").decode().replace("'", "''")
        parts, head = [], f"{name:<8}= "
        while len(quoted) > CARD - 12:
            n = CARD - 13
            n -= (len(quoted[:n]) - len(quoted[:n].rstrip("'"))) % 2  # a doubled quote stays in one card
            n -= len(quoted[:n]) - len(quoted[:n].rstrip(" "))  # blanks at a card's end would be lost
            if n <= 0:
                raise ValueError(f"{name} has more blanks in a row than a card holds")
            parts.append(f"{head}'{quoted[:n]}&'".ljust(CARD))
            quoted, head = quoted[n:], f"{'CONTINUE':<10}"
        return "".join([*parts, f"{head}'{quoted:<8}'".ljust(CARD)]).encode("ascii")
    return f"{name:<8}= {text}".ljust(CARD)[:CARD].encode("ascii")


def render(image: np.ndarray, header: dict | None = None, history: str | None = None) -> bytes:
    """A FITS file of 64-bit floats from an image indexed [x, y]."""
    nx, ny = image.shape
    own = {"SIMPLE": True, "BITPIX": -64, "NAXIS": 2, "NAXIS1": nx, "NAXIS2": ny}
    cards = b"".join(_card(k, v) for k, v in {**own, **{k: v for k, v in (header or {}).items() if k not in own}}.items())
    told = [line[i : i + CARD - 8] for line in (history or "").splitlines() for i in range(0, max(1, len(line)), CARD - 8)]
    cards += b"".join(f"HISTORY {line}".ljust(CARD).encode("ascii", "replace") for line in told) + b"END".ljust(CARD)
    data = np.ascontiguousarray(image.T, ">f8").tobytes()
    return cards.ljust(-(-len(cards) // BLOCK) * BLOCK) + data.ljust(-(-len(data) // BLOCK) * BLOCK, b"\0")


def kind_of(path: str, raw: bytes) -> str | None:
    """fits, lofarfits, hdf5, or None for what no reader takes."""
    if path.lower().split("?")[0].endswith((".h5", ".hdf5")) or raw.startswith(b"\x89HDF\r\n\x1a\n"):
        return "hdf5"
    if not raw.startswith(b"SIMPLE"):
        return None
    header, _, _ = parse_header(raw)
    return "lofarfits" if header.get("TELESCOP") == "LOFAR" and "ANTENNA" in header else "fits"


def read_images(spark: SparkSession, path: str | list[str], plane: int = 0, pixels: bool = True) -> DataFrame:
    """A row for each FITS file that path (a folder or glob, or a list) names; anything else is an error that names the file.

    Without pixels, only headers are parsed.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for name, raw in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if kind_of(name, raw) not in ("fits", "lofarfits"):
                    raise ValueError(f"no reader for {name}")
                if pixels:
                    header, history, data = parse(raw, plane)
                    rows.append((name, list(header.items()), history, data.shape[0], data.shape[1], data.ravel()))
                else:
                    header, history, _ = parse_header(raw)
                    rows.append((name, list(header.items()), history, int(header["NAXIS1"]), int(header["NAXIS2"]), None))
            kinds = [pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.float64())]
            columns = zip(*rows, strict=True) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["path", "header", "history", "nx", "ny", "pixels"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, SCHEMA)


def write_images(images: DataFrame, folder: str) -> int:
    """images(name, header map, nx, ny, pixels) as rows (name, content) of Parquet: each task writes its own through Spark's writer."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            made = []
            for header, nx, ny, pixels in zip(*(b.column(c).to_pylist() for c in ("header", "nx", "ny", "pixels")), strict=True):
                made.append(render(np.array(pixels, float).reshape(nx, ny), dict(header or [])))
            yield pa.RecordBatch.from_arrays([b.column("name"), pa.array(made, pa.binary())], names=["name", "content"])

    images.select("name", "header", "nx", "ny", "pixels").mapInArrow(run, "name string, content binary").write.mode("overwrite").parquet(folder)
    return images.sparkSession.read.parquet(folder).count()


def blobs(images: DataFrame) -> DataFrame:
    """images(image, header map, nx, ny, pixels) -> image, fits_header (its cards, a line each), fits_data (a FITS file)."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for image, header, nx, ny, pixels in zip(*(b.column(c).to_pylist() for c in ("image", "header", "nx", "ny", "pixels")), strict=True):
                cards = dict(header or [])
                raw = render(np.array(pixels, float).reshape(nx, ny), {k: v for k, v in cards.items() if k not in ("BSCALE", "BZERO", "SIMPLE", "BITPIX", "NAXIS")})  # pixels are scaled already
                yield pa.RecordBatch.from_arrays([pa.array([image], pa.int64()), pa.array(["\n".join(f"{k} = {v}" for k, v in cards.items())]), pa.array([raw], pa.binary())], names=["image", "fits_header", "fits_data"])

    return images.select("image", "header", "nx", "ny", "pixels").mapInArrow(run, "image long, fits_header string, fits_data binary")


# -- header columns ---------------------------------------------------------------------------------------------------


def number(header: Column, key: str) -> Column:
    return F.try_element_at(header, F.lit(key)).try_cast("double")


def text(header: Column, key: str) -> Column:
    return F.try_element_at(header, F.lit(key))


def frequency(h: Column) -> tuple[Column, Column]:
    """Effective frequency and bandwidth (1 MHz where only a rest frequency is known), first source that has one."""
    rest = number(h, "RESTFRQ")
    axis = lambda i: F.upper(F.coalesce(text(h, f"CTYPE{i}"), F.lit(""))).isin("FREQ", "VOPT") & number(h, f"CRVAL{i}").isNotNull()
    freq = F.coalesce(rest, F.when(axis(3), number(h, "CRVAL3")), F.when(axis(4), number(h, "CRVAL4")), number(h, "RESTFREQ"))
    width = F.when(rest.isNotNull(), F.coalesce(number(h, "RESTBW"), F.lit(1e6))).when(axis(3), number(h, "CDELT3")).when(axis(4), number(h, "CDELT4")).when(number(h, "RESTFREQ").isNotNull(), 1e6)
    return freq, width


def beam_degrees(h: Column, history: Column) -> tuple[Column, Column, Column]:
    """Major and minor axis and angle, from BMAJ, BMIN and BPA or else the last such line of the history."""
    found = lambda key: F.nullif(F.regexp_extract(history, rf"(?s).*{key}=\s*([-+0-9.eE]+)", 1), F.lit("")).try_cast("double")
    return tuple(F.coalesce(number(h, k), found(k)) for k in ("BMAJ", "BMIN", "BPA"))


#: Fixed value: days of a year, for dates written as a fraction of one.
YEAR_DAYS = 365.242199
#: Time systems that are zones; any other counts as UTC.
ZONE = r"^(Africa|America|Antarctica|Asia|Atlantic|Australia|Etc|Europe|Indian|Pacific)/\S+$"


def _written_start(h: Column) -> Column:
    """DATE-OBS as written: what stands in quotes before a semicolon, a date and time, or a year with a fraction."""
    raw = text(h, "DATE-OBS")
    part = F.split(raw, ";")[0]
    plain = F.when(raw.contains(";"), F.coalesce(F.nullif(F.regexp_extract(part, '"([^"]*)"', 1), F.lit("")), part)).otherwise(raw)
    year = F.when(F.trim(raw).rlike(r"^\d{4}\.\d*$"), raw.try_cast("double"))
    begin = F.make_timestamp(F.floor(year).cast("int"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return F.when(year.isNotNull(), F.timestamp_micros(F.unix_micros(begin) + F.round((year - F.floor(year)) * YEAR_DAYS * 86_400e6).cast("long"))).otherwise(F.try_to_timestamp(plain))


def start_time(h: Column) -> Column:
    """DATE-OBS as a timestamp in UTC, from the zone that TIMESYS names if it names one; null where there is no date.

    A zone of a known area and unknown place is an error.
    """
    zone = text(h, "TIMESYS")
    return F.when(zone.rlike(ZONE), F.to_utc_timestamp(_written_start(h), zone)).otherwise(_written_start(h))


def end_time(h: Column) -> Column:
    return F.try_to_timestamp(F.split(text(h, "END_UTC"), ";")[0])


def duration(h: Column) -> Column:
    """TAU_TIME of an image that names its aerials, else seconds from start to end of the observation, both as written; 0 where one is not known."""
    return F.coalesce(F.when(text(h, "ANTENNA").isNotNull(), number(h, "TAU_TIME")), (F.unix_micros(end_time(h)) - F.unix_micros(_written_start(h))) / 1e6, F.lit(0.0))


def beam_pixels(smaj: Column, smin: Column, pa: Column, dx: Column, dy: Column) -> tuple[Column, Column, Column]:
    """Half axes in pixels and angle in radians from full axes in degrees, along the pixel steps that the axes lie on."""
    t = F.radians(pa)
    along = F.sqrt(F.pow(dx * F.sin(t), 2) + F.pow(dy * F.cos(t), 2))
    across = F.sqrt(F.pow(dx * F.cos(t), 2) + F.pow(dy * F.sin(t), 2))
    return smaj / 2 / along, smin / 2 / across, t


def projection(h: Column) -> Column:
    """The projection that CTYPE1 names, SIN where there is none."""
    named = F.regexp_extract(F.coalesce(text(h, "CTYPE1"), F.lit("")), r"-([A-Z]{3})\s*$", 1)
    return F.when(named == "", "SIN").otherwise(named)


def in_degrees(h: Column, key: str, axis: int) -> Column:
    """A header's number in degrees, from radians where CUNIT says so."""
    unit = F.lower(F.coalesce(text(h, f"CUNIT{axis}"), F.lit("deg")))
    return F.when(unit.startswith("rad"), F.degrees(number(h, key))).otherwise(number(h, key))


def stations(h: Column) -> list[Column]:
    """The aerials and the numbers of core, remote and international stations, null where the header does not tell."""
    return [text(h, "ANTENNA").alias("antenna_set"), *(number(h, key).alias(key.lower()) for key in ("NCORE", "NREMOTE", "NINTL"))]


def metadata(images: DataFrame, *more: str) -> DataFrame:
    """path and the columns that every image must have, and more of images; a missing one or a pixel that is not square is an error."""
    h = F.col("header")
    freq, width = frequency(h)
    bmaj, bmin, bpa = beam_degrees(h, F.col("history"))
    dx, dy = in_degrees(h, "CDELT1", 1), in_degrees(h, "CDELT2", 2)
    square = F.when(F.abs(F.abs(dx) - F.abs(dy)) < 1e-7, dx).otherwise(F.raise_error(F.concat(F.lit("pixels are not square in "), F.col("path"))).cast("double"))
    smaj, smin, t = beam_pixels(bmaj, bmin, bpa, dx, dy)
    must = lambda c, name: F.coalesce(c, F.raise_error(F.concat(F.lit(f"no {name} in "), F.col("path"))).cast(c_type(name)))
    c_type = lambda name: "timestamp" if name == "start time" else "double"
    read = images.select(
        "path", "nx", "ny", F.col("path").alias("url"), square.alias("deltax"), dy.alias("deltay"), must(freq, "frequency").alias("freq_eff"), width.alias("freq_bw"), must(start_time(h), "start time").alias("taustart_ts"), duration(h).alias("tau_time"),
        smaj.alias("beam_smaj_pix"), smin.alias("beam_smin_pix"), t.alias("beam_pa_rad"), must(in_degrees(h, "CRVAL1", 1), "reference position").alias("crval1"), must(in_degrees(h, "CRVAL2", 2), "reference position").alias("crval2"),
        number(h, "CRPIX1").alias("crpix1"), number(h, "CRPIX2").alias("crpix2"), F.coalesce(number(h, "CROTA2"), F.lit(0.0)).alias("crota2"), text(h, "TELESCOP").alias("telescope"), projection(h).alias("projection"), *stations(h), *more,
    )
    w = {k: F.col(v) for k, v in (("crpix1", "crpix1"), ("crpix2", "crpix2"), ("crval1", "crval1"), ("crval2", "crval2"), ("cdelt1", "deltax"), ("cdelt2", "deltay"), ("crota2", "crota2"))}
    middle = F.transform(F.array(F.struct((F.col("nx") / 2).alias("x"), (F.col("ny") / 2).alias("y"))), lambda p: F.struct(*(c.alias(n) for c, n in zip(g.sky_of_pixel(p["x"], p["y"], w, F.col("projection")), ("ra", "decl"), strict=True))))[0]
    rest = [c for c in read.columns if c not in ("nx", "ny")]
    return read.withColumn("__m", middle).select(*rest, must(F.col("__m.ra"), "reference position").alias("centre_ra"), F.col("__m.decl").alias("centre_decl"), (F.least("nx", "ny") / 2 * F.abs("deltax")).alias("xtr_radius"))


def inject(header: Column, cards: dict[str, str], overwrite: bool = False) -> Column:
    """The header with more cards; those there stay unless overwrite."""
    added = F.create_map(*[F.lit(x) for kv in cards.items() for x in kv])
    theirs, ours = (F.map_filter(header, lambda k, v: ~k.isin(*cards)), added) if overwrite else (header, F.map_filter(added, lambda k, v: ~F.array_contains(F.map_keys(header), k)))
    return F.map_concat(theirs, ours)
