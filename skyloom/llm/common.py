"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that ends a word: blank and \t \n \v \f \r, nothing else.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a local one is set only where none is."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="skyloom-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame, parts: int | None = None) -> DataFrame:
    """A reliable checkpoint in the shared folder, in at most `parts` files: a table of ids needs far fewer than the shuffle before it."""
    shared_folder(df.sparkSession)
    return (df if parts is None else df.coalesce(parts)).checkpoint(eager=True)


def ascii_lower(c: Column) -> Column:
    """Only A-Z change; lower() would also fold other scripts."""
    return F.translate(c, UPPER, LOWER)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def parts_for(total: int, each: int, least: int = 1) -> int:
    """How many parts of about `each` units a total makes."""
    return max(least, -(-int(total) // each))


@cache
def _set_aside() -> None:
    """Once in a worker: what it has imported is left out of every later collection, which else took longer than a sort."""
    import gc

    gc.collect()
    gc.freeze()


def give_back() -> None:
    """In a Python worker: hands freed memory back to the system, since workers outlive their tasks and stages."""
    import ctypes
    import gc

    import pyarrow as pa

    _set_aside()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
