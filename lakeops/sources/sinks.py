"""Writers: partitioned tables, hourly landing, archives, alerts, metrics and the catalog."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.exprs import time_partition
from lakeops.sources.scan import check_codec


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (), codec: str = "snappy") -> None:
    """Parquet files; with partitions, rows of one partition are brought together first, so few files are written."""
    ready = gathered(df, partition_by) if partition_by else df
    ready.write.mode(mode).option("compression", codec).partitionBy(*partition_by).parquet(path)


def gathered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows brought together by output partition before a write.

    A rebalance, not a plain repartition: adaptive execution merges small partitions, so
    few files are written, and splits a partition that holds a large share of the rows.
    """
    return df.hint("rebalance", *keys)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "parquet", codec: str = "snappy") -> None:
    """Overwrite only the partitions present in ``df``."""
    check_codec(fmt, codec)
    writer = gathered(df, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", codec).partitionBy(*keys).format(fmt).save(path)


def write_format(df: DataFrame, fmt: str, path: str, codec: str = "none") -> None:
    check_codec(fmt, codec)
    writer = df.write.mode("overwrite").format(fmt)
    if codec != "none" or fmt in ("parquet", "orc"):
        writer = writer.option("compression", codec)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def land_events(df: DataFrame, path: str, ts: str = "ts", hour: bool = True) -> None:
    """JSON lines under year/month/day[/hour] folders of each row's own time."""
    parts = time_partition(ts, hour)
    gathered(df.withColumns(parts), list(parts)).write.mode("append").partitionBy(*parts).json(path)


def archive_jsonl(df: DataFrame, path: str, ts: str = "ts") -> None:
    parts = time_partition(ts, hour=False)
    gathered(df.withColumns(parts), list(parts)).write.mode("append").option("compression", "gzip").partitionBy(*parts).json(path)


def write_batch_once(df: DataFrame, batch_id: int, path: str) -> None:
    """Streaming sink for ``foreachBatch``: a replayed batch replaces its own folder."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """Counters that the writing job fills on its way, without jobs of their own."""
    seen = Observation(name)
    return df.observe(seen, *[expr.alias(k) for k, expr in measures.items()]), seen


def run_record(spark: SparkSession, job: str, as_of: str, measures: dict) -> DataFrame:
    """One-row description of a run, to be written as JSON."""
    items = [F.lit(job).alias("job"), F.lit(as_of).alias("run_at"), *[F.lit(v).alias(k) for k, v in measures.items()]]
    return spark.range(1).select(*items)


def register_table(spark: SparkSession, name: str, path: str, columns: str, partitioned_by: Sequence[str]) -> None:
    """External partitioned table over existing files; partitions are found from the folders."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(partitioned_by)}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")


def add_partition(spark: SparkSession, name: str, **values: str) -> None:
    """Make one new partition known; its folder is already there."""
    spec = ", ".join(f"{k}='{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec})")


def analyze_table(spark: SparkSession, name: str, columns: Sequence[str] = ()) -> None:
    """Row count and size of a table, and value statistics of ``columns``, for the planner's join order and broadcasts."""
    what = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS{what}")


def table_statistics(spark: SparkSession, name: str) -> dict[str, int]:
    """``bytes`` and, if counted, ``rows`` as the catalog knows them."""
    text = next((r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Statistics"), "")
    return {unit: int(n) for n, unit in re.findall(r"(\d+) (bytes|rows)", text)}
