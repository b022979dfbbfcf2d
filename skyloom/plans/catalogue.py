"""The catalogue as a log of changes: appended by version, laid out by cells of the sky, compacted now and then.

A table is a folder of generations, a generation one of versions, a version one of cells of CELL degrees. A commit appends
the rows that a step changed, and for rows that are gone their keys; then it publishes the version by a file in `_log`,
renamed into place, which also holds what the caller notes with it (the number of a stream's batch, say). So tables and
note are of one step, a reader sees a version whole or not at all, and what a lost attempt left is overwritten.

`read` takes the cells that it is asked for and the newest row of each key in each cell, a maximum that is combined before
the shuffle. Every EVERY versions the newest rows of tables with keys are written as a new generation, so that a step costs
what its cells hold and what changed there, and reads no more than EVERY versions of it. Tables that are only added to
(measurements, images) stay in their first generation and are never written again.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.operators import zone_join as z
from skyloom.operators.association import State
from skyloom.plans.schemas import DDL, schema

CELL, EVERY = 10, 16
#: Keys of tables of which rows change; the others are only added to.
KEYS = {
    "runningcatalog": ("runcat",), "runningcatalog_flux": ("runcat", "band", "stokes"), "assocxtrsource": ("runcat", "xtrsrc"), "assocskyrgn": ("runcat", "skyrgn"), "newsource": ("runcat", "trigger_xtrsrc"),
    "varmetric": ("runcat",), "monitor": ("id",), "dataset": ("id",),
}
#: Tables whose rows lie where their source or measurement does; rows of the others lie in cell 0.
ON_SKY = {"runningcatalog", "runningcatalog_flux", "assocxtrsource", "assocskyrgn", "newsource", "varmetric", "monitor", "extractedsource"}
STATE = {"runcat": "runningcatalog", "flux": "runningcatalog_flux", "assoc": "assocxtrsource", "skyrgn": "assocskyrgn", "newsource": "newsource"}


def cell_of(ra: str, decl: str) -> Column:
    strip = F.floor(F.col(decl) / CELL).cast("int")
    return strip * 1000 + z.cell(strip, F.col(ra), CELL)


def cells_of(fields: DataFrame, margin: float) -> list[int]:
    """The cells that fields(centre_ra, centre_decl, xtr_radius) and a margin touch: at most some 400."""
    radius = F.col("xtr_radius") + margin
    strips = fields.withColumn("__s", F.explode(z.strips(F.col("centre_decl"), radius, CELL)))
    reached = strips.select(F.col("__s"), F.explode(z.reached(F.col("__s"), F.col("centre_ra"), F.col("centre_decl"), radius, CELL)).alias("c"))
    return sorted(r[0] for r in reached.select((F.col("__s") * 1000 + F.col("c"))).distinct().collect())


class Catalogue:
    """Tables under a root that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str, every: int = EVERY):
        self.spark, self.root, self.every = spark, root.rstrip("/"), every

    # -- files ------------------------------------------------------------------------------------------------------

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _folder(self, name: str, generation: int) -> str:
        return f"{name}/{generation if name in KEYS else 0}"

    def log(self) -> dict:
        """What was published last: version, generation, and the caller's note."""
        path, fs = self._path("_log")
        names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        last = max((n for n in names if n.isdigit()), default=None)
        if last is None:
            return {"version": 0, "generation": 0, "note": {}}
        file = fs.open(self._path(f"_log/{last}")[0])
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
        finally:
            file.close()

    def _publish(self, entry: dict) -> None:
        name = f"_log/{entry['version']:012d}"
        draft, fs = self._path(f"{name}.draft")
        out = fs.create(draft, True)
        out.write(json.dumps(entry).encode())
        out.close()
        final, _ = self._path(name)
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"version {entry['version']} of {self.root} was published by another writer")

    # -- reading ----------------------------------------------------------------------------------------------------

    def read(self, name: str, cells: list[int] | None = None, celled: bool = False) -> DataFrame:
        """The newest rows of a table, of all cells or some; with their cell, if asked."""
        entry, rows = self.log(), schema(name)
        home = self._folder(name, entry["generation"])
        path, fs = self._path(home)
        columns = [f.name for f in rows]
        if not fs.exists(path):
            found = self.spark.createDataFrame([], rows).withColumn("cell", F.lit(0))
        else:
            kept = schema(name).add("gone", "boolean").add("version", "long").add("cell", "integer")
            found = self.spark.read.schema(kept).parquet(f"{self.root}/{home}").filter(F.col("version") <= entry["version"])
            if cells is not None and name in ON_SKY:
                found = found.filter(F.col("cell").isin(cells))
            if name in KEYS:
                newest = F.max_by(F.struct("gone", *(c for c in columns if c not in KEYS[name])), "version").alias("r")
                found = found.groupBy(*KEYS[name], "cell").agg(newest).filter("NOT r.gone").select(*KEYS[name], "cell", "r.*")
        return found.select(*columns, *(["cell"] if celled else []))

    def state(self, cells: list[int] | None = None) -> State:
        return State(**{k: self.read(name, cells) for k, name in STATE.items()})

    # -- writing ----------------------------------------------------------------------------------------------------

    def _write(self, name: str, generation: int, version: int, rows: DataFrame) -> None:
        rows.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{self.root}/{self._folder(name, generation)}/version={version}")

    def commit(self, changes: dict[str, DataFrame], note: dict | None = None) -> int:
        """Appends changes(columns, cell, and gone where rows are) and publishes them with the note. The version."""
        entry = self.log()
        version, generation = entry["version"] + 1, entry["generation"]
        for name in DDL:  # what an attempt that was lost left of this version
            stale, fs = self._path(f"{self._folder(name, generation)}/version={version}")
            fs.delete(stale, True)
        full = {n: df.withColumns({c: F.lit(v) for c, v in (("gone", False), ("cell", 0)) if c not in df.columns}) for n, df in changes.items()}
        with ThreadPoolExecutor(8) as pool:  # tables do not depend on each other
            list(pool.map(lambda n: self._write(n, generation, version, full[n]), full))
        self._publish({"version": version, "generation": generation, "note": note or entry["note"]})
        if version % self.every == 0:
            self.compact()
        return version

    def compact(self) -> None:
        """The newest rows as the first version of a new generation."""
        entry = self.log()
        version, generation = entry["version"] + 1, entry["generation"] + 1
        names = [n for n in KEYS if (p := self._path(f"{n}/{entry['generation']}"))[1].exists(p[0])]
        with ThreadPoolExecutor(8) as pool:
            list(pool.map(lambda n: self._write(n, generation, version, self.read(n, celled=True).withColumn("gone", F.lit(False))), names))
        self._publish({"version": version, "generation": generation, "note": entry["note"]})


def placed(rows: DataFrame, where: DataFrame) -> DataFrame:
    """rows(runcat, ...) with the cell of where(runcat, cell)."""
    return rows.join(where, "runcat")


def difference(name: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows, and keys of rows gone, that lead from one table(columns, cell) to the next."""
    keys = [*KEYS[name], "cell"]
    new = after.subtract(before).withColumn("gone", F.lit(False))
    gone = before.select(*keys).subtract(after.select(*keys)).withColumn("gone", F.lit(True))
    return new.unionByName(gone, allowMissingColumns=True)


def state_changes(before: State, after: State) -> dict[str, DataFrame]:
    """Changes of the five tables from one state of some cells to the next. A source that moved to another cell takes its rows along."""
    out = {}
    where = [s.runcat.select("runcat", cell_of("wm_ra", "wm_decl").alias("cell")) for s in (before, after)]
    for attribute, name in STATE.items():
        out[name] = difference(name, *(placed(getattr(s, attribute), w) for s, w in zip((before, after), where, strict=True)))
    return out
