"""Readers: partitioned tables, JSON lines, CSV, other formats, envelopes and scored lines."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeops.session import settings
from lakeops.sources import folders

CORRUPT = "_corrupt_record"
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# fixed values: codecs that work with each format ("none" always does)
CODECS = {
    "parquet": ["snappy", "gzip", "zstd"],
    "orc": ["snappy", "zlib", "zstd"],
    "json": ["gzip"],
    "csv": ["gzip"],
    "avro": ["snappy", "deflate"],
}


def scan_date_range(spark: SparkSession, root: str, target: str, lookback_days: int = 0, column: str = "date") -> DataFrame:
    """Target day and the days before it; one scan whose partition filter skips the rest.

    A missing day is simply a partition that is not there.
    """
    end = date.fromisoformat(target)
    first = end - timedelta(days=lookback_days)
    return spark.read.parquet(root).filter(F.col(column).between(F.lit(first), F.lit(end)))


def read_parquet(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def scan_ndjson(spark: SparkSession, path: str, schema: str | None = None, recursive: bool = True) -> DataFrame:
    """JSON lines; with a schema, unreadable lines keep their text in ``_corrupt_record``."""
    reader = spark.read.option("recursiveFileLookup", recursive)
    if schema is not None:
        reader = reader.schema(f"{schema}, {CORRUPT} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def scan_csv(spark: SparkSession, paths: str | Sequence[str], schema: str, required: Sequence[str] = ()) -> DataFrame:
    """CSV with a header; fails early when a required column is missing from any file."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    wanted = spark.createDataFrame([], schema).schema
    # The first line of every file: files of one table may hold their columns in another order.
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("line"))
    heads = lines.filter(F.col("block") == 0).groupBy("file").agg(F.min_by("value", "line").alias("head"))
    shapes: dict[str, list[str]] = {}
    for head, files in heads.groupBy("head").agg(F.collect_list("file").alias("files")).collect():
        names = next(csv.reader([head.lstrip("\ufeff")]))
        missing = [n for n in required if n not in names]
        if missing:
            raise ValueError(f"{files[0]}: missing columns {missing}")
        shapes[head] = files
    parts = []
    for head, files in shapes.items():
        names = next(csv.reader([head.lstrip("\ufeff")]))
        own = StructType([wanted[n] if n in wanted.names else StructField(n, StringType()) for n in names])
        rows = spark.read.option("header", True).schema(own).csv(files)
        parts.append(rows.select(*[F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted]))
    if not parts:
        return spark.createDataFrame([], wanted)
    return reduce(DataFrame.unionByName, parts)


def check_codec(fmt: str, codec: str) -> None:
    if codec != "none" and codec not in CODECS.get(fmt, []):
        raise ValueError(f"{fmt} cannot be written with {codec}; choose one of {['none', *CODECS.get(fmt, [])]}")


def scan_format(spark: SparkSession, fmt: str, path: str, schema: str | None = None) -> DataFrame:
    """Any built-in format (avro needs its module on the class path)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def explode_log_envelope(df: DataFrame, body: str, event_schema: str) -> DataFrame:
    """Envelope -> messages -> typed events; control messages and unreadable ones give no row."""
    envelope = F.from_json(body, "messageType string, logGroup string, logEvents array<struct<id string, timestamp bigint, message string>>")
    opened = df.select(envelope.alias("e")).filter(F.col("e.messageType") == "DATA_MESSAGE")
    events = opened.select(F.col("e.logGroup").alias("log_group"), F.explode("e.logEvents").alias("m"))
    read = F.from_json("m.message", f"{event_schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    typed = events.select("log_group", F.col("m.id").alias("id"), F.col("m.timestamp").alias("timestamp"), read.alias("event"))
    good = typed.filter(F.col("event").isNotNull() & F.col(f"event.{CORRUPT}").isNull())
    return good.select("log_group", "id", "timestamp", "event.*").drop(CORRUPT)


def parse_variant(df: DataFrame, body: str, fields: dict[str, tuple[str, str, object]]) -> DataFrame:
    """Columns read from JSON text of changing shape: ``fields`` maps a column to (path, type, default).

    The text is parsed once. A field that is absent, null or not readable as its type gets the default; ``is_bad`` marks
    texts that are no JSON at all.
    """
    parsed = df.withColumn("_v", F.try_parse_json(body))
    named = {n: F.coalesce(F.try_variant_get("_v", path, kind), F.lit(default).cast(kind)) for n, (path, kind, default) in fields.items()}
    return parsed.withColumns(named | {"is_bad": F.col("_v").isNull()}).drop("_v")


def parse_scored_lines(df: DataFrame, line: str, schema: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Typed results of one-result-per-line output, and the lines that could not be read."""
    parsed = df.withColumn("_p", F.from_json(line, schema))
    good = F.col("_p")[key].isNotNull()
    return parsed.filter(good).select("_p.*"), parsed.filter(~good | F.col("_p").isNull()).select(line)


def whole_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per text file, with a repeatable id from its address below ``path``.

    Spark names its files anew in every run, but numbers them alike: of such a name only the number counts. Folders that
    Python reaches are listed and read in tasks. Elsewhere, and where files are compressed, Spark reads them and the driver
    holds the list of files.
    """
    address = F.regexp_replace("address", r"(^|/)part-(\d+)-[^/]*$", "$1part-$2")
    found = _texts_by_tasks(spark, path)
    files = (_texts_by_spark(spark, path) if found is None else found).withColumn("address", address)
    return files.select(F.left(F.sha2("address", 256), F.lit(16)).alias("document_id"), "address", "text")


def _texts_by_tasks(spark: SparkSession, path: str) -> DataFrame | None:
    root = folders.folder_in_reach(spark, path)
    if root is None:
        return None
    files, count, size, packed = folders.files_below(spark, root)
    return None if packed else folders.read_files(files, root, count, size).select("address", F.col("content").cast("string").alias("text"))


def _texts_by_spark(spark: SparkSession, path: str) -> DataFrame:
    below = F.regexp_extract(F.col("_metadata.file_path"), "/" + re.escape(path.rstrip("/").rsplit("/", 1)[-1]) + "/(.*)$", 1)
    # the files are listed here; without a limit that takes a task for every folder, up to 10,000
    with settings(spark, {LISTING_TASKS: str(4 * spark.sparkContext.defaultParallelism)}):
        files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return files.select(below.alias("address"), F.col("value").alias("text"))


def partition_sizes(spark: SparkSession, root: str, key: str = "day") -> DataFrame:
    """Files and bytes per partition value; only file listings are read, never contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    part = F.regexp_extract("path", rf"{key}=([^/]+)", 1)
    return files.groupBy(part.alias(key)).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).filter(F.col(key) != "")


def union_days(frames: Sequence[DataFrame]) -> DataFrame:
    """Daily tables by column name; columns a day lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
