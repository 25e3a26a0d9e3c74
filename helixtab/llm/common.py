"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtab.workspace import new_folder, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_MASK = (1 << 64) - 1

_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of a batch that goes to Python while texts are staged; a longer text is a batch of its own.
TEXT_BATCH = 2 << 20
_M1, _M2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

__all__ = [
    "ascii_lower",
    "discard",
    "mix64",
    "new_folder",
    "read_table",
    "returning_memory",
    "shuffle_partitions",
    "stage",
    "stage_texts",
    "text_or_empty",
    "unused_name",
]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def unused_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores added until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over an array of unsigned integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(_M1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(_M2)
    x ^= x >> np.uint64(31)
    return x


def returning_memory(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over the batches of a task, after which free memory goes back to the system.

    A worker is used again by later stages; what its allocator keeps would count against them.
    """

    def held(batches: Iterator) -> Iterator:
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # another C library: nothing to give back
            pass

    return held


def stage_texts(df: DataFrame, label: str = "stage") -> DataFrame:
    """``stage`` for a table made from whole texts in Python, which get there in batches of bounded size.

    The setting is the session's as it was afterwards, as the table is written by then.
    """
    conf = df.sparkSession.conf
    before = conf.get(_BATCH_CONF, None)
    conf.set(_BATCH_CONF, str(TEXT_BATCH))
    try:
        return stage(df, label)
    finally:
        if before is None:
            conf.unset(_BATCH_CONF)
        else:
            conf.set(_BATCH_CONF, before)


def discard(df_or_path: DataFrame | str, spark: SparkSession | None = None) -> None:
    """Delete a staged table that nothing returned to the caller reads any more."""
    if isinstance(df_or_path, DataFrame):
        spark = df_or_path.sparkSession
        paths = {f.rsplit("/", 1)[0] for f in df_or_path.inputFiles()}
    else:
        paths = {df_or_path}
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
