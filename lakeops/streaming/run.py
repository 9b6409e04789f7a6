"""Opening, parsing, running and sinking streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from lakeops.operators.search import latest_per_key
from lakeops.session import fresh_dir, settings
from lakeops.sources.sinks import write_batch_once

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def parse_events(stream: DataFrame, body: str, schema: str, required: str) -> DataFrame:
    """Typed rows from JSON text or bytes, with arrival time and a flag for unreadable ones."""
    typed = stream.withColumn("_raw", F.col(body).cast("string")).withColumn("_e", F.from_json("_raw", schema))
    bad = F.col("_e").isNull() | F.col(f"_e.{required}").isNull()
    return typed.select("_e.*", F.current_timestamp().alias("arrived_at"), bad.alias("is_bad"), F.when(bad, F.col("_raw")).alias("raw"))


@contextmanager
def state_settings(spark: SparkSession):
    """RocksDB state and one state partition per core: the partition count of a stateful
    stream is fixed at its first start and cannot be adapted later."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism),
    }
    with settings(spark, wanted):
        yield


def drain(writer: DataStreamWriter) -> None:
    """Run until everything that is there has been read; errors are raised, not swallowed."""
    started = writer.trigger(availableNow=True).start()
    started.awaitTermination()


def open_folder(spark: SparkSession, path: str, schema, size: int = 4 << 30) -> DataFrame:
    """Stream over the files of a folder. A micro-batch takes about ``size`` bytes, which bounds the rows that one key can have in it."""
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", size).parquet(path)


def closing_row(rows: DataFrame, ts: str, later: str) -> DataFrame:
    """One row without values but a time ``later`` (an interval) after the last one: fed as a last slice, it lets every open
    window and timer end. Operators behind ``state.with_clock`` never see it."""
    at = F.expr(f"max(`{ts}`) + INTERVAL {later}").alias(ts)
    end = rows.agg(at).where(F.col(ts).isNotNull())
    return end.select(*(F.col(f.name).cast(f.dataType) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields))


def replay(slices: Sequence[DataFrame], build: Callable[[DataFrame, str], DataStreamWriter], label: str) -> str:
    """Feed slices one after the other to a stream that restarts from its checkpoint each time.

    ``build(stream, folder)`` returns a writer; the checkpoint lives in ``folder/_state``.
    """
    spark = slices[0].sparkSession
    folder = fresh_dir(spark, label)
    source = f"{folder}/source"
    schema = slices[0].schema
    with state_settings(spark):
        for part in slices:
            part.write.mode("append").parquet(source)
            stream = open_folder(spark, source, schema)
            drain(build(stream, folder).option("checkpointLocation", f"{folder}/_state"))
    return folder


def to_folder(stream: DataFrame, folder: str, mode: str = "append", name: str = "out") -> DataStreamWriter:
    """Write every micro-batch to its own folder, so a repeated batch cannot add rows twice."""
    return stream.writeStream.outputMode(mode).foreachBatch(lambda df, i: write_batch_once(df, i, f"{folder}/{name}"))


def read_batches(spark: SparkSession, folder: str, schema, name: str = "out") -> DataFrame:
    return spark.read.schema(schema).option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}")


def last_values(batches: DataFrame, key: Sequence[str]) -> DataFrame:
    """Current value per key of a stream written in update mode."""
    return latest_per_key(batches, key, ["batch_id"]).drop("batch_id")
