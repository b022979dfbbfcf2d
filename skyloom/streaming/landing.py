"""Image streams that survive a restart: frames land in shared storage, and a partitioned source reads what has landed.

`receive` is a job of one task an endpoint, so endpoints are read side by side in executors, each by a connection that stays
open. A whole frame becomes a file, numbered within its endpoint, before anything downstream hears of it; a task that is
tried again goes on with the next number. What a connection held of a frame when it broke is lost, as the wire has no
acknowledgement.

`LandedFrames` is the source: its offsets are the numbers landed, for each endpoint, its partitions ranges of them, read in
executors. A batch that is run again reads the same files. They are cleared when Spark tells that their batch is done, or
by the one who uses them, where `clear` is false.
"""

from __future__ import annotations

import json
import logging
import threading
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from skyloom.sources import files
from skyloom.streaming.timesteps import frame_bytes, image_rows, read_frame

log = logging.getLogger(__name__)
STOP, CLEARED = "_stop", "_cleared"


def _home(landing: str, endpoint: int) -> str:
    return f"{landing.rstrip('/')}/{endpoint}"


def cleared(landing: str, endpoint: int) -> int:
    """Up to which number an endpoint's frames have been cleared."""
    home = _home(landing, endpoint)
    return json.loads(files.get(f"{home}/{CLEARED}")) if CLEARED in files.names(home) else 0


def landed(landing: str, endpoint: int) -> int:
    """The last number of an endpoint's frames."""
    numbers = [int(n) for n in files.names(_home(landing, endpoint)) if n.isdigit()]
    return max(numbers, default=cleared(landing, endpoint))


def clear(landing: str, endpoint: int, last: int) -> None:
    """Removes an endpoint's frames up to a number. The number is kept first, so that numbers are never given again."""
    home = _home(landing, endpoint)
    if last > cleared(landing, endpoint):
        files.put(f"{home}/{CLEARED}", json.dumps(last).encode())
    for n in files.names(home):
        if n.isdigit() and int(n) <= last:
            files.remove(f"{home}/{n}")


def land(endpoint: str, home: str, landing: str, wait: float) -> int:
    """Lands the frames of host:port until the sender is done for good or a stop is asked for. How many."""
    import socket

    files.folder(home)
    host, port = endpoint.rsplit(":", 1)
    number, got = landed(landing, int(home.rpartition("/")[2])), 0
    quiet = time.monotonic()
    while STOP not in files.names(landing) and time.monotonic() - quiet < wait:
        try:
            with socket.create_connection((host, int(port)), timeout=wait) as s:
                while STOP not in files.names(landing):
                    cards, data = read_frame(s.recv)
                    number, got, quiet = number + 1, got + 1, time.monotonic()
                    files.put(f"{home}/{number:012d}", frame_bytes(cards, data))
        except (OSError, ValueError) as e:  # closed, refused, silent or out of step: connect again
            log.warning("endpoint %s: %s", endpoint, e)
            time.sleep(min(wait, 0.2))
    return got


def receive(spark: SparkSession, endpoints: list[str], landing: str, wait: float = 5.0) -> threading.Thread:
    """Starts the receiving job. It ends where an endpoint sends nothing for `wait` seconds, or at `stop`."""
    files.folder(landing)
    files.remove(f"{landing}/{STOP}")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for i in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([land(endpoints[i], _home(landing, i), landing, wait)])], names=["endpoint", "frames"])

    job = spark.range(0, len(endpoints), 1, len(endpoints)).mapInArrow(run, "endpoint long, frames long")
    thread = threading.Thread(target=lambda: job.collect(), daemon=True)  # a count an endpoint
    thread.start()
    return thread


def stop(landing: str) -> None:
    files.put(f"{landing}/{STOP}", b"")


@dataclass
class Range(InputPartition):
    endpoint: int
    first: int
    last: int


class LandedReader(DataSourceStreamReader):
    def __init__(self, options):
        self.landing, self.endpoints = options["landing"], int(options["endpoints"])
        self.most, self.clear = int(options.get("most", 1 << 60)), options.get("clear", "true") == "true"
        self.told: dict[str, int] = {}

    def initialOffset(self):
        return {str(i): cleared(self.landing, i) for i in range(self.endpoints)}

    def latestOffset(self):
        for i in range(self.endpoints):
            done = self.told.get(str(i), cleared(self.landing, i))
            self.told[str(i)] = max(done, min(landed(self.landing, i), done + self.most))
        return dict(self.told)

    def partitions(self, start, end):
        self.told = {k: max(v, self.told.get(k, 0)) for k, v in end.items()}
        found = [Range(int(i), start[i] + 1, end[i]) for i in end if end[i] > start[i]]
        return found or [Range(0, 1, 0)]

    def read(self, partition):
        for n in range(partition.first, partition.last + 1):
            url = f"{_home(self.landing, partition.endpoint)}/{n:012d}"
            sent = memoryview(files.get(url))
            at = [0]

            def take(size, sent=sent, at=at):
                at[0] += size
                return bytes(sent[at[0] - size : at[0]])

            cards, data = read_frame(take)
            yield partition.endpoint, n, url, cards, data

    def commit(self, end):
        if self.clear:
            for i, last in end.items():
                clear(self.landing, int(i), last)


class LandedFrames(DataSource):
    """spark.dataSource.register(LandedFrames); spark.readStream.format("landed_frames").option("landing", folder).option("endpoints", n)

    most: frames of an endpoint in a batch at most. clear: "false" leaves clearing to the one who uses the frames.
    """

    @classmethod
    def name(cls):
        return "landed_frames"

    def schema(self):
        return "endpoint int, number long, url string, cards string, data binary"

    def streamReader(self, schema):
        return LandedReader(self.options)


def landed_images(spark: SparkSession, urls: list[str]) -> DataFrame:
    """Landed frames as rows of the FITS reader, each read where it is worked on."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for url in b.column(0).to_pylist():
                sent, at = files.get(url), [0]

                def take(size, sent=sent, at=at):
                    at[0] += size
                    return sent[at[0] - size : at[0]]

                cards, data = read_frame(take)
                yield pa.RecordBatch.from_arrays([pa.array([cards]), pa.array([data], pa.binary())], names=["cards", "data"])

    frames = spark.createDataFrame([(u,) for u in urls], "url string").repartition(max(1, len(urls)), "url")
    return image_rows(frames.mapInArrow(run, "cards string, data binary")).drop("ts")
