"""Stream mode: landed frames, grouped by time, each group a time step of a stored catalogue."""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyloom.plans.batch import OF_DATA, Survey
from skyloom.sources import files, fits
from skyloom.streaming import landing as ld
from skyloom.streaming.timesteps import groups_kept

log = logging.getLogger(__name__)


class SurveySteps:
    """foreachBatch handler: takes each time group of a batch into the catalogue, in order.

    The number of the batch and of the group in it are committed with the step's own tables, so a stream that is killed,
    within a batch or between two, takes up at the group after the last one committed. A group that its data make fail
    is logged and passed over. Frames are cleared when a later batch begins, since until then Spark may run theirs again;
    which ones is noted in the landing folder.
    """

    def __init__(self, survey: Survey, landing: str):
        self.survey, self.landing, self.failed = survey, landing.rstrip("/"), []

    def _clear(self, number: int) -> None:
        """Removes the frames that batches before this one have used."""
        done = f"{self.landing}/_done"
        for name in files.names(done):
            if int(name.split("-")[0]) < number:
                for url in json.loads(files.get(f"{done}/{name}")):
                    files.remove(url)
                files.remove(f"{done}/{name}")

    def __call__(self, batch: DataFrame, number: int) -> None:
        files.folder(f"{self.landing}/_done")
        self._clear(number)
        groups = batch.select("ts", "urls").orderBy("ts", "urls").collect()  # urls of the time steps of a batch
        for k, g in enumerate(groups):
            note = self.survey.store.log()["note"]
            if (number, k) <= (note["batch"], note["step"]):
                continue
            files.put(f"{self.landing}/_done/{number}-{k}", json.dumps(g["urls"]).encode())
            try:
                self.survey.take(ld.landed_images(batch.sparkSession, g["urls"]), {"batch": number, "step": k})
            except OF_DATA:
                log.exception("time step %s failed", g["ts"])
                self.failed.append(g["ts"])
                self.survey.store.commit({}, {"batch": number, "step": k})


def grouped(frames: DataFrame) -> DataFrame:
    """frames(url, cards, data) -> ts, urls: the images of each time over all endpoints, once another time has come."""
    h = F.col("header")
    rows = headers(frames).select(F.lit("all").alias("key"), fits.start_time(h).alias("ts"), "url", fits.frequency(h)[0].alias("freq_eff"))
    return groups_kept(rows, "key").select("ts", "urls")


def headers(frames: DataFrame) -> DataFrame:
    """url, header of frames(url, cards); pixels are not looked at."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            found = []
            for cards in b.column("cards").to_pylist():
                text = cards.encode("ascii", "replace")
                header, _, _ = fits.parse_header(text.ljust(-(-len(text) // fits.CARD) * fits.CARD) + b"END".ljust(fits.CARD))
                found.append(list(header.items()))
            yield pa.RecordBatch.from_arrays([b.column("url"), pa.array(found, pa.map_(pa.string(), pa.string()))], names=["url", "header"])

    return frames.select("url", "cards").mapInArrow(run, "url string, header map<string,string>")


def start(spark: SparkSession, landing: str, endpoints: int, survey: Survey, checkpoint: str, most: int | None = None, once: bool = False) -> StreamingQuery:
    """The stream from a landing folder into a catalogue. once: what has landed by now, then it ends."""
    spark.dataSource.register(ld.LandedFrames)
    source = spark.readStream.format("landed_frames").option("landing", landing).option("endpoints", endpoints).option("clear", "false")
    frames = (source.option("most", most) if most else source).load()
    writer = grouped(frames).writeStream.foreachBatch(SurveySteps(survey, landing)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


__all__ = ["SurveySteps", "grouped", "headers", "start"]
