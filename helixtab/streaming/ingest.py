"""Resumable ingest of arriving chunk files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def read_chunk_stream(
    spark: SparkSession, folder: str, schema, file_format: str = "parquet", max_files: int | None = None, **options
) -> DataFrame:
    """A stream over the files that arrive in a folder."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def ingest_new(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """R-01: each arrived file is written exactly once; a later run goes on where this one ended."""
    return (
        stream.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def running_counts(stream: DataFrame, keys: Sequence[str], out: str, checkpoint: str) -> StreamingQuery:
    """R-02: counts per key while chunks arrive.

    Every update batch is written to its own folder, so a repeated batch replaces itself;
    ``latest_counts`` gives the present state.
    """
    counts = stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{out}/update-{batch_id:012d}"
        )

    return (
        counts.writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_counts(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """The last value written per key; counts only grow."""
    return spark.read.parquet(f"{out}/update-*").groupBy(*keys).agg(F.max("n").alias("n"))


_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class FirstRow(StatefulProcessor):
    """Keyed state of one flag per id: whether its first row has been given out."""

    def __init__(self, order: Sequence[str]):
        self.order = list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.given = handle.getValueState("given", "yes boolean")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        if self.given.exists():
            return
        self.given.update((True,))
        yield min(rows, key=lambda r: tuple((r[c] is not None, r[c]) for c in self.order))

    def close(self) -> None:
        pass


def _firsts_of_batches(ids: list[str], order: list[str]):
    """Within each Arrow batch the first row of an id, so that a frequent id sends few rows."""
    import pyarrow as pa

    def thin(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            where = pa.array(range(batch.num_rows), pa.int64())
            keyed = table.select(ids).append_column("_at", where)
            if order:
                by = [(c, "ascending") for c in order]
                keyed = keyed.take(pa.compute.sort_indices(table, sort_keys=by, null_placement="at_start"))
            kept = keyed.group_by(ids, use_threads=False).aggregate([("_at", "first")])["_at_first"]
            yield from table.take(kept.combine_chunks()).combine_chunks().to_batches()

    return thin


def _exists(spark: SparkSession, path: str) -> bool:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(conf).exists(target)


def ingest_distinct(
    stream: DataFrame, ids: Sequence[str], out: str, checkpoint: str, ord_cols: Sequence[str]
) -> StreamingQuery:
    """R-03: the first row of each id over all batches.

    A stateful processor keeps one flag per id in a RocksDB state store, which is restored from the checkpoint after a
    restart; rows that were written are never read again.  Within a batch the first row by
    ``ord_cols`` counts (nulls first), and the file sink commits each batch once.  The output belongs to its
    checkpoint: a new checkpoint over a folder that is already there raises.
    """
    spark = stream.sparkSession
    if _exists(spark, out) and not _exists(spark, checkpoint):
        raise ValueError(f"{out} was written with another checkpoint")
    ids, order = list(ids), list(ord_cols)
    firsts = (
        stream.mapInArrow(_firsts_of_batches(ids, order), stream.schema)
        .groupBy(*ids)
        .transformWithState(FirstRow(order), stream.schema, "Append", "None")
    )
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)  # taken over by the query at its start
    try:
        return (
            firsts.writeStream.format("parquet").option("path", out).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def read_distinct(spark: SparkSession, out: str) -> DataFrame:
    """What ``ingest_distinct`` has committed."""
    return spark.read.parquet(out)
