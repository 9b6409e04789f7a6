"""Text files in partition folders: written as a Spark data source, for tables with about one row per folder, and read back.

Spark's own writer opens a file for every folder through Hadoop, which took 37 ms of a task per file on a local file system,
most of it waiting. Here a task writes the files of its rows itself.
Folders are named and escaped as ``partitionBy`` does, a file holds one line per row. Files get the number of their task, so
a task that is run again replaces its own files; ``path`` must be new, and a failed job deletes it.

Spark's readers list every file in the driver. Here folders are listed level by level in tasks and the lists are stored, so
the driver holds no list of files, however many there are.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from lakeops.session import materialize

FORMAT = "text_folders"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
SPECIAL = re.compile(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]")
#: Characters that Spark's file paths hold as %XX.
QUOTED = re.compile(r"[\x00-\x20\"#%<>?\[\\\]^`{|}\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Names that Spark's readers pass over, and endings of files that they unpack.
HIDDEN, PACKED = re.compile(r"\.|_[^=]*$|.*\._COPYING_$", re.S), r"\.(gz|bz2|deflate|lz4|snappy|zst)$"
#: Folders that one task lists; files, and about as many bytes, that one task reads; bytes and rows that it hands on at once.
FOLDERS_PER_TASK, FILES_PER_TASK, BYTES_PER_TASK = 5_000, 5_000, 64 << 20
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1_000


@dataclass
class Written(WriterCommitMessage):
    """Number of files of one task."""

    files: int


class TextFolders(DataSource):
    """Options: ``path`` (a folder all executors can reach) and ``depth``; the first ``depth`` columns name the folders, the next is the text."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return TextFoldersWriter(self.options["path"], schema.names, int(self.options["depth"]))


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


class TextFoldersWriter(DataSourceWriter):
    def __init__(self, path: str, names: Sequence[str], depth: int):
        self.path, self.names, self.depth = path.rstrip("/"), list(names), depth

    def _folder(self, row: Row) -> str:
        return "/".join(f"{name}={folder_value(row[i])}" for i, name in enumerate(self.names[: self.depth]))

    def write(self, iterator: Iterator[Row]) -> Written:
        store, root = _store(self.path)
        name, files = f"part-{TaskContext.get().partitionId():05d}-c000.txt", 0
        for folder, rows in groupby(iterator, self._folder):
            store.create_dir(f"{root}/{folder}")
            with store.open_output_stream(f"{root}/{folder}/{name}") as out:
                for row in rows:
                    out.write(f"{'' if row[self.depth] is None else row[self.depth]}\n".encode())
            files += 1
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        store.create_dir(root)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        if store.get_file_info(root).type != fs.FileType.NotFound:
            store.delete_dir(root)


def folder_value(value: str | None) -> str:
    """A partition value as part of a path."""
    return NO_VALUE if value is None else SPECIAL.sub(lambda m: f"%{ord(m[0]):02X}", value)


def write_text_folders(df: DataFrame, path: str, keys: Sequence[str], text: str, rows: int = 2_000) -> None:
    """The texts of ``df`` below ``path``, one folder for each value of ``keys`` and one file in it.

    A file costs about the same however short it is, so tasks get about ``rows`` rows each, whatever their bytes.
    """
    spark = df.sparkSession
    spark.dataSource.register(TextFolders)
    tasks = max(spark.sparkContext.defaultParallelism, -(-df.count() // rows))
    named = [F.nullif(df[k].cast("string"), F.lit("")).alias(k) for k in keys]
    dealt = df.select(*named, text).repartition(tasks, *keys).sortWithinPartitions(*keys)
    dealt.write.format(FORMAT).mode("append").option("path", path).option("depth", len(keys)).save()


# --- reading ----------------------------------------------------------------------

LISTED = pa.schema([("place", pa.string()), ("folder", pa.bool_()), ("size", pa.int64())])
READ = pa.schema([("address", pa.string()), ("content", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def folder_in_reach(spark: SparkSession, path: str) -> str | None:
    """The full address of a folder that tasks can read themselves; None if only Spark's readers can, or if it is no folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toUri()
    address = full.getPath() if full.getScheme() == "file" else full.toString()
    try:
        store, root = _store(address)
        return address if store.get_file_info(root).type == fs.FileType.Directory else None
    except (OSError, ValueError):
        return None


def _children(store: fs.FileSystem, folder: str) -> Iterator[tuple[str, bool, int]]:
    """(name, is a folder, bytes) of what a folder holds. Local names are streamed, as one folder may hold millions."""
    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            for x in found:
                is_folder = x.is_dir()
                yield x.name, is_folder, 0 if is_folder else x.stat().st_size
    else:
        for x in store.get_file_info(fs.FileSelector(folder)):
            yield x.base_name, x.type == fs.FileType.Directory, x.size or 0


def files_below(spark: SparkSession, root: str) -> tuple[DataFrame, int, int, int]:
    """(place, size) of every file below ``root`` that is neither hidden nor empty; their number, bytes, and how many are packed.

    A level of folders is listed by tasks of up to ``FOLDERS_PER_TASK`` folders and its list is stored; so there is one job
    for every level.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(root)
        held: list[tuple[str, bool, int]] = []
        for folder in (place for batch in batches for place in batch.column(0).to_pylist()):
            for name, is_folder, size in _children(store, f"{top}/{folder}"):
                if not HIDDEN.match(name):
                    held.append((f"{folder}{name}{'/' if is_folder else ''}", is_folder, size))
                if len(held) >= 10 * BATCH_ROWS:
                    yield _batch(held, LISTED)
                    held = []
        yield _batch(held, LISTED)

    level = spark.range(0, 1, 1, 1).select(F.lit("").alias("place"))
    found, totals = [], [0, 0, 0]
    is_file = ~F.col("folder") & (F.col("size") > 0)
    while True:
        met = materialize(level.mapInArrow(listed, "place string, folder boolean, size bigint"), "listing")
        count = met.agg(
            F.count_if("folder").alias("folders"), F.count_if(is_file).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
            F.count_if(is_file & F.col("place").rlike(PACKED)).alias("packed"),
        ).first()
        totals = [a + count[n] for a, n in zip(totals, ("files", "bytes", "packed"), strict=True)]
        if count["files"] or not count["folders"]:
            found.append(met.filter(is_file).select("place", "size"))
        if not count["folders"]:
            return reduce(DataFrame.unionByName, found), *totals
        tasks = max(spark.sparkContext.defaultParallelism, -(-count["folders"] // FOLDERS_PER_TASK))
        level = met.filter("folder").select("place").repartition(tasks)


def read_files(files: DataFrame, root: str, count: int, size: int) -> DataFrame:
    """(address, content): every file as it is; the address is its place below ``root``, quoted as in Spark's file paths."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(root)
        held: list[tuple[str, bytes]] = []
        held_bytes = 0
        for place in (place for batch in batches for place in batch.column(0).to_pylist()):
            with store.open_input_stream(f"{top}/{place}", compression=None) as source:
                content = source.read()
            held.append((quoted(place), content))
            held_bytes += len(content)
            if held_bytes >= BATCH_BYTES or len(held) >= BATCH_ROWS:
                yield _batch(held, READ)
                held, held_bytes = [], 0
        yield _batch(held, READ)

    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-count // FILES_PER_TASK), -(-size // BYTES_PER_TASK))
    return files.select("place").repartition(tasks).mapInArrow(read, "address string, content binary")


def quoted(place: str) -> str:
    return QUOTED.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), place)
