import datetime
import socket
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions import clock, geometry, uncertain
from skyloom.operators import images as im
from skyloom.sources import fits, tables
from skyloom.streaming import timesteps as ts


def test_fits_round_trip_through_spark(spark, tmp_path):
    image = np.random.default_rng(0).normal(size=(6, 9))
    header = {"CRVAL1": 180.0, "CRVAL2": 30.0, "CRPIX1": 3.0, "CRPIX2": 4.0, "CDELT1": -0.01, "CDELT2": 0.01, "RESTFRQ": 6e7, "BMAJ": 0.1, "BMIN": 0.05, "BPA": 0.0, "DATE-OBS": "2024-01-02T03:04:05;x", "OBJECT": "it's"}
    (tmp_path / "a.fits").write_bytes(fits.render(image, header))
    read = fits.read_images(spark, str(tmp_path / "*.fits"))
    row = read.first()
    assert (np.array(row.pixels).reshape(row.nx, row.ny) == image).all() and row.header["OBJECT"] == "it's"
    m = fits.metadata(read).first()
    assert (m.freq_eff, m.freq_bw) == (6e7, 1e6) and m.beam_smaj_pix == pytest.approx(5) and m.taustart_ts == datetime.datetime(2024, 1, 2, 3, 4, 5)


def test_integer_fits_planes_and_kinds():
    data = np.arange(24, dtype=">i2").reshape(2, 4, 3)
    cards = b"".join(fits._card(k, v) for k, v in {"SIMPLE": True, "BITPIX": 16, "NAXIS": 3, "NAXIS1": 3, "NAXIS2": 4, "NAXIS3": 2, "BSCALE": 2.0, "BZERO": 1.0}.items()) + b"END".ljust(80)
    raw = cards.ljust(2880) + data.tobytes()
    assert (fits.parse(raw, 1)[2] == data[1].T * 2.0 + 1).all()
    assert fits.kind_of("x.fits", raw) == "fits" and fits.kind_of("x.h5", b"") == "hdf5" and fits.kind_of("x", b"no") is None
    lofar = b"".join(fits._card(k, v) for k, v in {"SIMPLE": True, "TELESCOP": "LOFAR", "ANTENNA": "HBA"}.items()) + b"END".ljust(80)
    assert fits.kind_of("x.fits", lofar) == "lofarfits"
    with pytest.raises(ValueError):
        fits.parse(b"JUNK")


def test_written_images_read_back(spark, tmp_path):
    df = spark.createDataFrame([("a", {"OBJECT": "x"}, 2, 2, [1.0, 2.0, 3.0, 4.0])], "name string, header map<string,string>, nx int, ny int, pixels array<double>")
    assert fits.write_images(df, str(tmp_path / "out")) == 1
    raw = spark.read.parquet(str(tmp_path / "out")).first().content
    assert fits.parse(bytes(raw))[2].tolist() == [[1, 2], [3, 4]]


def test_config_and_tables(spark):
    config = tables.parse_config("[a]\nx = 3\ny = 2.5\nz = True\ns = word\nt = 2024-01-02T03:04:05\n")
    assert config["a"]["x"] == 3 and config["a"]["s"] == "word" and config["a"]["t"] == datetime.datetime(2024, 1, 2, 3, 4, 5)
    rows = tables.store_config({"a": {"x": 3, "z": True, "password": "p", "f": 1.5}})
    assert tables.fetch_config([dict(zip(("dataset", "section", "key", "value", "type"), r, strict=True)) for r in rows]) == {"a": {"x": 3, "z": True, "f": 1.5}}
    with pytest.raises(TypeError):
        tables.store_config({"a": {"x": []}})
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, v string")
    assert [r.key for r in tables.columns_from_table(df, ["id"], {"id": "key"}, {"v": None}).collect()] == [2]
    with pytest.raises(ValueError):
        tables.prepared(df, "other")


def test_text_sinks(spark):
    found = spark.createDataFrame([(1, 10.0, 20.0, 3.0, 2.0, 45.0, 1.5, 1.25)], "xtrsrc long, ra double, decl double, semimajor double, semiminor double, pa double, f_peak double, f_int double")
    assert tables.region_lines(found).first().value == 'ellipse(10.000000, 20.000000, 3.0000", 2.0000", 45.00)'
    assert tables.csv_lines(found).first().value == "10.000000, 20.000000, 1.500000, 1.250000"
    assert tables.sky_model_lines(found).first().value.startswith("1, POINT, 10.0")


def test_sexagesimal_errors(spark):
    one = spark.range(1)
    with pytest.raises(Exception, match="within 90"):
        one.select(clock.decl_to_dms(F.lit(91.0))).collect()
    with pytest.raises(Exception, match="different sign"):
        one.select(clock.dms_to_decl(F.lit(1), F.lit(-3), F.lit(0.0))).collect()
    assert one.select(clock.dms_to_decl(F.lit(0), F.lit(-30), F.lit(0.0)).alias("d")).first().d == -0.5


def test_frames_invert_and_known_points(spark):
    lon, lat = geometry.eq_to_gal(F.lit(266.40499), F.lit(-28.93617))
    row = spark.range(1).select(lon.alias("l"), lat.alias("b")).first()
    assert min(row.l, 360 - row.l) < 1e-3 and abs(row.b) < 1e-3
    ra, d = geometry.gal_to_eq(*geometry.eq_to_gal(F.lit(123.4), F.lit(-45.6)))
    row = spark.range(1).select(ra.alias("ra"), d.alias("d")).first()
    assert (row.ra, row.d) == pytest.approx((123.4, -45.6))
    w = {k: F.lit(v) for k, v in {"crpix1": 10.0, "crpix2": 20.0, "crval1": 359.9, "crval2": 60.0, "cdelt1": -0.1, "cdelt2": 0.1, "crota2": 30.0}.items()}
    for p in ("SIN", "TAN"):
        x, y = geometry.pixel_of_sky(*geometry.sky_of_pixel(F.lit(3.0), F.lit(40.0), w, p), w, p)
        row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
        assert (row.x, row.y) == pytest.approx((3, 40))


def test_sidereal_time(spark):
    row = spark.range(1).select(clock.sidereal_degrees(F.lit(51544.5), F.lit(0.0)).alias("g"), clock.mjd(F.lit("2000-01-01 12:00:00").cast("timestamp")).alias("m"), clock.of_mjd(F.lit(51544.5)).alias("t")).first()
    assert row.g == pytest.approx(280.46061837) and row.m == 51544.5 and row.t == datetime.datetime(2000, 1, 1, 12)


def test_uncertain(spark):
    a, b = uncertain.uncertain(3.0, 0.3), uncertain.uncertain(0.0, 0.1)
    r = spark.range(1).select(uncertain.divide(a, b).alias("d"), uncertain.power(a, 2).alias("p"), uncertain.surely_less(b, a).alias("less"), uncertain.negative(a).alias("n")).first()
    assert r.d.value is None and (r.p.value, r.p.error) == pytest.approx((9, 1.8)) and r.less and r.n.value == -3


def test_bands_in_order(spark):
    bands, found = im.get_or_create_bands(spark, [], [(100.0, 10.0), (104.0, 10.0), (130.0, 10.0), (126.0, 2.0)])
    assert found == [1, 1, 2, 2] and len(bands) == 2


def test_covered_time_of_nested_ranges(spark):
    df = spark.createDataFrame([(1, 0, 10), (1, 2, 8), (1, 4, 6), (1, 20, 25), (2, 0, 1)], "k int, s long, e long")
    assert {r.k: r.covered for r in im.union_length(df, "k", "s", "e").collect()} == {1: 15, 2: 1}


# -- streams --------------------------------------------------------------------------------------------------------------


def test_groups_by_time_keep_late_images():
    feed = [(1, "a"), (1, "b"), (2, "c"), (1, "late"), (3, "d")]
    assert list(ts.merged(iter(feed))) == [(1, ["a", "b"]), (2, ["c"]), (1, ["late"])]
    assert list(ts.merged(iter(feed), flush=True))[-1] == (3, ["d"])


def test_frames_over_a_pipe():
    image = np.arange(6, dtype="f4").reshape(2, 3)
    left, right = socket.socketpair()
    left.sendall(ts.frame("CARD", image))
    cards, data = ts.read_frame(right.recv)
    assert cards == "CARD" and (np.frombuffer(data, "<f4").reshape(2, 3) == image).all()
    left.sendall(b"x" * 512)
    with pytest.raises(ValueError):
        ts.read_frame(right.recv)
    left.close()
    with pytest.raises(ConnectionError):
        ts.read_frame(right.recv)


def test_socket_reader_counts_frames():
    server = socket.create_server(("127.0.0.1", 0))
    port = server.getsockname()[1]

    def send():
        c, _ = server.accept()
        for i in range(3):
            c.sendall(ts.frame(f"n{i}", np.zeros((1, 1))))
        c.close()

    t = threading.Thread(target=send)
    t.start()
    reader = ts.ImageSocketReader({"endpoints": f"127.0.0.1:{port}", "retry": "1"})
    at, got = reader.initialOffset(), []
    for _ in range(3):
        rows, at = reader.read(at)
        got += [r[1] for r in rows]
    t.join()
    server.close()
    assert got == ["n0", "n1", "n2"] and at == {"n": 3} and [r[1] for r in reader.readBetweenOffsets({"n": 1}, {"n": 3})] == ["n1", "n2"]


def test_stream_replay_equals_batch(spark, tmp_path):
    rows = [(datetime.datetime(2024, 1, 1, 0, 0, s // 2), f"u{s}", float(9 - s)) for s in range(12)]
    for i in range(0, 12, 4):
        spark.createDataFrame(rows[i : i + 4], "ts timestamp, url string, freq_eff double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    seen, failures = {}, []

    def step(when, images):
        seen[when] = [i.url for i in images]
        if when.second == 2:
            failures.append(when)
            raise RuntimeError("bad image")

    handler = ts.Steps(step)
    stream = ts.by_time(spark.readStream.schema("ts timestamp, url string, freq_eff double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), "0 seconds")
    q = stream.writeStream.foreachBatch(handler).outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    want = {r.ts: r.urls for r in im.group_per_timestep(spark.read.parquet(str(tmp_path / "in"))).collect()}
    assert all(want[t] == urls for t, urls in seen.items()) and len(seen) >= 4 and handler.failed == failures


def test_frames_become_image_rows(spark):
    image = np.arange(6.0).reshape(2, 3)  # indexed [x, y]
    raw = fits.render(image, {"TELESCOP": "T", "DATE-OBS": "2024-01-01T00:00:00", "END_UTC": "2024-01-01T00:00:02", "RESTFRQ": 5e7})
    cards = raw[: fits.parse_header(raw)[2]].decode("ascii")
    frames = spark.createDataFrame([("e", c, image.T.astype("<f4").tobytes()) for c in (cards, cards[: cards.index("END  ")])], "endpoint string, cards string, data binary")
    for row in ts.image_rows(frames).collect():
        assert row.pixels == image.ravel().tolist() and (row.nx, row.ny) == (2, 3)
        assert row.path == "memory://T_2024-01-01 00:00:00_2.0_5.0E7_1000000.0" and row.ts == datetime.datetime(2024, 1, 1)
    assert ts.image_rows(frames.limit(0)).collect() == []


def test_emulated_stream_through_groups(spark, tmp_path):
    found = []
    rows = ts.image_rows(ts.emulated(spark, 3, 8)).select("ts", "nx", F.size("pixels").alias("n"))
    q = rows.writeStream.foreachBatch(lambda b, n: found.extend(b.collect())).option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        for _ in range(60):
            if len(found) >= 3 or not q.isActive:
                break
            q.awaitTermination(1)
    finally:
        q.stop()
    assert len(found) >= 3 and {(r.nx, r.n) for r in found} == {(8, 64)}


def test_stateful_groups_keep_late_images(spark, tmp_path):
    day = lambda d: datetime.datetime(2024, 1, d)
    batches = [[("a", day(1), "u2", 2.0), ("a", day(1), "u1", 1.0)], [("a", day(1), "u0", 0.5), ("a", day(2), "v", 1.0), ("b", day(9), "w", 1.0)], [("a", day(1), "late", 1.0)], [("a", day(3), "x", 1.0)]]
    schema, home = "station string, ts timestamp, url string, freq_eff double", str(tmp_path / "in")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(home)
        stream = ts.groups_kept(spark.readStream.schema(schema).parquet(home))
        q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination()
    found = sorted(((r.station, r.ts.day, r.urls) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=str)
    feed = ((t, u) for rows in batches for s, t, u, f in sorted(rows, key=lambda r: (r[1], r[3])) if s == "a")
    assert found == sorted((("a", t.day, ["u0", "u1", "u2"] if t.day == 1 and "late" not in g else g) for t, g in ts.merged(feed)), key=str)
    assert ("a", 1, ["late"]) in found and not any(s == "b" for s, *_ in found)


def test_a_restarted_stream_skips_batches_done(spark, tmp_path):
    batch, seen = spark.createDataFrame([(1, ["u"])], "ts int, images array<string>"), []
    for number in (0, 0, 1):
        ts.Steps(lambda t, images: seen.append(t), marker=str(tmp_path / "done"))(batch, number)
    assert seen == [1, 1]


def test_start_times(spark):
    at = datetime.datetime
    cases = [
        ({"DATE-OBS": "2012-08-08T20:58:40.3", "END_UTC": "2012-08-08T20:58:41.3"}, at(2012, 8, 8, 20, 58, 40, 300000), 1.0),
        ({"DATE-OBS": 'x "2012-08-08T20:58:40";rest', "TIMESYS": "UTC"}, at(2012, 8, 8, 20, 58, 40), 0.0),
        ({"DATE-OBS": "2012-08-08T20:00:00", "END_UTC": "2012-08-08T20:00:05", "TIMESYS": "Europe/Amsterdam"}, at(2012, 8, 8, 18), 5.0),
        ({"DATE-OBS": "2012-08-08T20:00:00", "TIMESYS": "LOCAL"}, at(2012, 8, 8, 20), 0.0),
        ({"DATE-OBS": "2005.5"}, at(2005, 1, 1) + datetime.timedelta(365.242199 / 2), 0.0),
        ({"DATE-OBS": "yesterday"}, None, 0.0),
        ({}, None, 0.0),
    ]
    rows = spark.createDataFrame([(i, h) for i, (h, *_) in enumerate(cases)], "i int, h map<string,string>")
    found = rows.select(fits.start_time(F.col("h")).alias("start"), fits.duration(F.col("h")).alias("tau")).orderBy("i").collect()
    assert [(r.start, r.tau) for r in found] == [(s, t) for _, s, t in cases]
