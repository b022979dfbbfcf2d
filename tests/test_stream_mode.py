import socket
import threading

import numpy as np
import pytest

from skyloom.imaging import kernels as k
from skyloom.plans import batch
from skyloom.sources import files, fits
from skyloom.streaming import landing as ld
from skyloom.streaming import steps
from skyloom.streaming.timesteps import frame

SETTINGS = {"sys_err_arcsec": 10.0, "tile": (24, 24)}


def shot(t: int, band: int) -> tuple[np.ndarray, dict]:
    """A steady source, and one that is gone in the second step; two bands."""
    x, y = np.indices((48, 48))
    image = np.random.default_rng(10 * t + band).normal(0, 1, (48, 48))
    for peak, a, b, when in ((60, 14, 30, range(9)), (50, 34, 12, (0, 2, 3))):
        if t in when:
            image += k.gaussian(k.Shape(peak, a, b, 2.5, 2.5, 0.0), x, y)
    header = {"CRVAL1": 180.0, "CRVAL2": 30.0, "CRPIX1": 24.0, "CRPIX2": 24.0, "CDELT1": -0.01, "CDELT2": 0.01, "RESTFRQ": 6e7 + 4e6 * band, "BMAJ": 0.05, "BMIN": 0.05, "BPA": 0.0, "DATE-OBS": f"2024-01-0{t + 1}T00:00:00", "END_UTC": f"2024-01-0{t + 1}T00:05:00"}
    return image.astype("<f4").astype(float), header


def sent(t: int, band: int) -> bytes:
    image, header = shot(t, band)
    raw = fits.render(image, header)
    return frame(raw[: fits.parse_header(raw)[2]].decode("ascii"), image.T)


@pytest.fixture
def servers():
    """Two senders; what is handed to them goes to whoever is connected."""
    made = []

    def serve(frames: list[bytes]) -> str:
        s = socket.create_server(("127.0.0.1", 0))
        made.append(s)

        def run():
            c, _ = s.accept()
            with c:
                for f in frames:
                    c.sendall(f)

        threading.Thread(target=run, daemon=True).start()
        return f"127.0.0.1:{s.getsockname()[1]}"

    yield serve
    for s in made:
        s.close()


def test_frames_land_once_and_numbers_go_on(spark, servers, tmp_path):
    home = str(tmp_path / "landing")
    for turn in range(2):
        ends = [servers([sent(2 * turn, b), sent(2 * turn + 1, b)]) for b in (0, 1)]
        ld.receive(spark, ends, home, wait=2.0).join(60)
        assert [ld.landed(home, i) for i in (0, 1)] == [2 * turn + 2] * 2
        assert files.get(f"{home}/1/{2 * turn + 1:012d}") == sent(2 * turn, 1)
        ld.clear(home, 0, 1)
    assert ld.cleared(home, 0) == 1 and len(files.names(f"{home}/0")) == 4 and len(files.names(f"{home}/1")) == 4


def test_source_reads_each_frame_once_over_restarts(spark, tmp_path):
    home, out, check = (str(tmp_path / n) for n in ("landing", "out", "check"))
    spark.dataSource.register(ld.LandedFrames)

    def run():
        frames = spark.readStream.format("landed_frames").option("landing", home).option("endpoints", 2).load()
        frames.select("endpoint", "number", "cards").writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(once=True).start().awaitTermination()
        return sorted((r.endpoint, r.number) for r in spark.read.parquet(out).collect())

    for i, n in ((0, 1), (0, 2), (1, 1)):
        files.folder(f"{home}/{i}")
        files.put(f"{home}/{i}/{n:012d}", sent(n, i))
    assert run() == [(0, 1), (0, 2), (1, 1)]
    files.put(f"{home}/1/{2:012d}", sent(2, 1))
    assert run() == [(0, 1), (0, 2), (1, 1), (1, 2)]


def tables(survey):
    s = survey.store.state()
    found = {"runcat": s.runcat.select("runcat", "datapoints", "wm_ra", "wm_decl", "forcedfits_count"), "flux": s.flux.select("runcat", "band", "f_datapoints", "avg_f_int"), "assoc": s.assoc.select("runcat", "xtrsrc", "type"), "skyrgn": s.skyrgn.select("runcat", "skyrgn"), "newsource": s.newsource, "varmetric": survey.store.read("varmetric").select("runcat", "v_int", "band")}
    return {n: sorted(map(str, df.collect())) for n, df in found.items()}


def test_a_killed_stream_makes_the_tables_of_a_batch_run(spark, tmp_path, monkeypatch):
    """Killed within a batch, after its first time step; then between two batches; the result is that of one run over files."""
    home, store, check = (str(tmp_path / n) for n in ("landing", "store", "check"))

    def land(times):
        for t in times:
            for b in (0, 1):
                files.folder(f"{home}/{b}")
                files.put(f"{home}/{b}/{t + 1:012d}", sent(t, b))

    land((0, 1, 2))  # two whole time steps and one that is open
    survey = batch.Survey(spark, store, **SETTINGS)
    taken, take = [], batch.Survey.take

    def dying(self, read, note=None):
        if note["step"] == 1 and not taken:
            taken.append(note)
            raise RuntimeError("killed")
        return take(self, read, note)

    monkeypatch.setattr(batch.Survey, "take", dying)
    with pytest.raises(Exception, match="killed"):
        steps.start(spark, home, 2, survey, check, once=True).awaitTermination()
    assert survey.store.log()["note"] == {"batch": 0, "step": 0} and survey.store.read("image").count() == 2
    steps.start(spark, home, 2, batch.Survey(spark, store, **SETTINGS), check, once=True).awaitTermination()
    assert batch.Survey(spark, store, **SETTINGS).store.read("image").count() == 4
    land((3,))
    steps.start(spark, home, 2, batch.Survey(spark, store, **SETTINGS), check, once=True).awaitTermination()
    streamed = batch.Survey(spark, store, **SETTINGS)
    assert streamed.store.read("image").count() == 6 and files.names(f"{home}/0") == [f"{n:012d}" for n in (3, 4)]  # the others were of batches that are done

    folder = tmp_path / "files"
    folder.mkdir()
    for t in range(3):
        for b in (0, 1):
            (folder / f"{t}{b}.fits").write_bytes(fits.render(*shot(t, b)))
    monkeypatch.undo()
    batch.run(spark, str(folder / "*.fits"), str(tmp_path / "batch"), **SETTINGS)
    assert tables(streamed) == tables(batch.Survey(spark, str(tmp_path / "batch"), **SETTINGS))


def test_other_settings_are_an_error(spark, tmp_path):
    batch.Survey(spark, str(tmp_path / "s"), detection=9.0)
    with pytest.raises(ValueError, match="detection"):
        batch.Survey(spark, str(tmp_path / "s"), detection=8.0)
