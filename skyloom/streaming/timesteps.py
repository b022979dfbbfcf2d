"""Streams of images: framing, a socket source, grouping by time, and processing of time steps."""

from __future__ import annotations

import logging
import struct
import time
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, InputPartition, SimpleDataSourceStreamReader

from skyloom.sources import fits

# The wire format: magic number, two lengths, and a header block of 512 bytes.
MAGIC, HEAD = 0x47494A53484F4D4F, 512
log = logging.getLogger(__name__)


def frame_bytes(cards: str, data: bytes) -> bytes:
    text = cards.encode()
    return struct.pack("<QII", MAGIC, len(text), len(data)).ljust(HEAD, b"\0") + text + data


def frame(cards: str, image: np.ndarray) -> bytes:
    return frame_bytes(cards, np.ascontiguousarray(image, "<f4").tobytes())


def read_exactly(receive: Callable[[int], bytes], n: int) -> bytes:
    parts = []
    while n:
        got = receive(min(n, 1 << 16))
        if not got:
            raise ConnectionError("the sender closed the stream")
        parts.append(got)
        n -= len(got)
    return b"".join(parts)


def read_frame(receive: Callable[[int], bytes]) -> tuple[str, bytes]:
    magic, cards, data = struct.unpack("<QII", read_exactly(receive, HEAD)[:16])
    if magic != MAGIC:
        raise ValueError("the stream is out of step: wrong magic number")
    return read_exactly(receive, cards).decode(), read_exactly(receive, data)


class ImageSocketReader(SimpleDataSourceStreamReader):
    """Frames from endpoints host:port,host:port; offsets count frames. A lost connection is tried again."""

    def __init__(self, options):
        self.endpoints = [e.rsplit(":", 1) for e in options["endpoints"].split(",")]
        self.wait = float(options.get("retry", 5))
        self.sockets: dict[int, object] = {}
        self.kept: list[tuple] = []

    def initialOffset(self):
        return {"n": 0}

    def read(self, start):
        import socket

        rows = []
        for i, (host, port) in enumerate(self.endpoints):
            try:
                if i not in self.sockets:
                    self.sockets[i] = socket.create_connection((host, int(port)), timeout=self.wait)
                cards, data = read_frame(self.sockets[i].recv)
                rows.append((f"{host}:{port}", cards, data))
            except (OSError, ValueError) as e:
                log.error("endpoint %s:%s: %s", host, port, e)
                self.sockets.pop(i, None)
                time.sleep(min(self.wait, 0.2))
        self.kept += rows
        return iter(rows), {"n": start["n"] + len(rows)}

    def readBetweenOffsets(self, start, end):
        return iter(self.kept[start["n"] : end["n"]])


class ImageSocket(DataSource):
    """spark.dataSource.register(ImageSocket); spark.readStream.format("image_socket").option("endpoints", "host:port")"""

    @classmethod
    def name(cls):
        return "image_socket"

    def schema(self):
        return "endpoint string, cards string, data binary"

    def simpleStreamReader(self, schema):
        return ImageSocketReader(self.options)


def image_rows(frames: DataFrame) -> DataFrame:
    """Frames (cards, data) as rows of the FITS reader, and ts; path is memory:// and telescope, start, seconds, frequency, bandwidth."""

    def run(batches):
        import pyarrow as pa

        kinds = [pa.map_(pa.string(), pa.string()), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.float64())]
        for b in batches:
            rows = []
            for cards, data in zip(b.column("cards").to_pylist(), b.column("data").to_pylist(), strict=True):
                text = cards.encode("ascii", "replace")
                header, history, _ = fits.parse_header(text.ljust(-(-len(text) // fits.CARD) * fits.CARD) + b"END".ljust(fits.CARD))
                nx, ny = int(header["NAXIS1"]), int(header["NAXIS2"])
                rows.append((list(header.items()), history, nx, ny, np.frombuffer(data, "<f4").reshape(ny, nx).T.astype(float).ravel()))
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["header", "history", "nx", "ny", "pixels"])

    h = F.col("header")
    freq, width = fits.frequency(h)
    name = F.concat_ws("_", fits.text(h, "TELESCOP"), fits.start_time(h).cast("string"), fits.duration(h).cast("string"), freq.cast("string"), width.cast("string"))
    rows = frames.select("cards", "data").mapInArrow(run, fits.SCHEMA.removeprefix("path string, "))
    return rows.select(F.concat(F.lit("memory://"), name).alias("path"), "header", "history", "nx", "ny", "pixels", fits.start_time(h).alias("ts"))


def emulated(spark: SparkSession, endpoints: int = 6, size: int = 32, first: str = "2024-01-01T00:00:00") -> DataFrame:
    """A stream as ImageSocket gives it, made from Spark's rate source: each second, noise from every endpoint, a band each."""

    def run(batches):
        import pyarrow as pa

        begin = np.datetime64(first, "s")
        for b in batches:
            names, cards, data = [], [], []
            for v in b.column("value").to_pylist():
                second, i = divmod(v, endpoints)
                header = {"NAXIS1": size, "NAXIS2": size, "TELESCOP": "EMULATED", "DATE-OBS": str(begin + second), "END_UTC": str(begin + second + 1), "RESTFRQ": 5e7 + i * 1e6, "CDELT1": -0.1, "CDELT2": 0.1, "CRPIX1": size / 2, "CRPIX2": size / 2, "CRVAL1": 0.0, "CRVAL2": 50.0, "BMAJ": 0.3, "BMIN": 0.3, "BPA": 0.0}
                image = np.random.default_rng(v).normal(size=(size, size))
                raw = fits.render(image, header)
                names.append(f"emulated:{i}")
                cards.append(raw[: fits.parse_header(raw)[2]].decode("ascii"))
                data.append(np.ascontiguousarray(image.T, "<f4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(cards, pa.string()), pa.array(data, pa.binary())], names=["endpoint", "cards", "data"])

    rate = spark.readStream.format("rate").option("rowsPerSecond", endpoints).load()
    return rate.select("value").mapInArrow(run, "endpoint string, cards string, data binary")


def merged(frames: Iterator[tuple], flush: bool = False) -> Iterator[tuple[object, list]]:
    """Groups (ts, item) of an ordered feed: a group ends when another time arrives; late items begin a group of their own."""
    current, held = None, []
    for ts, item in frames:
        if held and ts != current:
            if ts < current:
                log.error("an image of %s came after %s", ts, current)
            yield current, held
            held = []
        current = ts
        held.append(item)
    if flush and held:
        yield current, held


def by_time(stream: DataFrame, delay: str = "1 second", ts: str = "ts", columns=("url", "freq_eff")) -> DataFrame:
    """ts, images: the images of each time, in order of frequency, once the watermark has passed it. Later ones are dropped."""
    ordered = F.array_sort(F.collect_list(F.struct(*reversed(columns))))
    return stream.withWatermark(ts, delay).groupBy(ts).agg(ordered.alias("images"))


def groups_kept(stream: DataFrame, key: str = "station", ts: str = "ts", url: str = "url", freq: str = "freq_eff") -> DataFrame:
    """key, ts, urls: the stateful form of `merged` for each key, urls in order of frequency; late images form groups of their own.

    Images of one micro-batch count as arrived in order of time. State is one open group a key, its urls and frequencies.
    """

    def run(group, tables, state):
        import pandas as pd

        rows = pd.concat(list(tables)).sort_values(["t", "freq", "url"], kind="stable")  # short rows of one micro-batch
        at, urls, freqs = state.get if state.exists else (None, [], [])
        urls, freqs, out = list(urls), list(freqs), []
        for t, u, f in zip(rows.t.tolist(), rows.url.tolist(), rows.freq.tolist(), strict=True):
            if at is not None and t != at:
                if t < at:
                    log.error("an image of %s came after %s", t, at)
                out.append((group[0], at, [u for _, u in sorted(zip(freqs, urls, strict=True))]))
                urls, freqs = [], []
            at = t
            urls.append(u)
            freqs.append(f)
        state.update((at, urls, freqs))
        yield pd.DataFrame(out, columns=["key", "t", "urls"])

    short = stream.select(F.col(key).cast("string").alias("key"), F.unix_micros(ts).alias("t"), F.col(url).alias("url"), F.col(freq).cast("double").alias("freq"))
    out = short.groupBy("key").applyInPandasWithState(run, "key string, t long, urls array<string>", "t long, urls array<string>, freqs array<double>", "append", "NoTimeout")
    return out.select(F.col("key").alias(key), F.timestamp_micros("t").alias(ts), "urls")


class Steps:
    """foreachBatch handler that runs `step` on each time group in order, skipping batches already done and logging errors.

    backlog: groups beyond this many in one batch are dropped, oldest first, with an error in the log.
    marker: a folder for the numbers of batches done, so that a restarted stream skips them, too.
    """

    def __init__(self, step: Callable[[object, list], None], ts: str = "ts", backlog: int | None = None, marker: str | None = None):
        self.step, self.ts, self.backlog, self.marker, self.done, self.failed = step, ts, backlog, marker, None, []

    def last(self, spark: SparkSession) -> int:
        """The number of the last batch done, -1 before the first."""
        if self.done is None:
            self.done = -1
            if self.marker:
                try:
                    found = spark.read.schema("done long").parquet(self.marker).agg(F.max("done")).first()[0]
                    self.done = -1 if found is None else found
                except AnalysisException as e:
                    if e.getCondition() != "PATH_NOT_FOUND":
                        raise
        return self.done

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number <= self.last(spark):
            return
        groups = batch.orderBy(self.ts).collect()  # one row for each time step of this micro-batch
        if self.backlog is not None and len(groups) > self.backlog:
            log.error("dropping %d time steps", len(groups) - self.backlog)
            groups = groups[-self.backlog :]
        for g in groups:
            try:
                self.step(g[self.ts], g["images"])
            except Exception:
                log.exception("time step %s failed", g[self.ts])
                self.failed.append(g[self.ts])
        if self.marker:
            spark.createDataFrame([(number,)], "done long").write.mode("append").parquet(self.marker)
        self.done = number


__all__ = ["ImageSocket", "InputPartition", "Steps", "by_time", "emulated", "frame", "groups_kept", "image_rows", "merged", "read_frame"]
