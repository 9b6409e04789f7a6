"""A keyed put as a Spark data source: rows of a batch go to a folder store once per key, also when the batch is repeated.

``df.write.format("keyed_put")`` hands every partition to a writer in its own task. A task writes one file below a staging
folder; the driver moves the files of all tasks that succeeded into the batch's folder, or removes them when the job fails.
A batch that is put again replaces its own folder, so a replay changes nothing. Readers take the row of the newest batch
per key.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "keyed_put"


@dataclass
class Put(WriterCommitMessage):
    """What one task has put: its file (none for an empty partition) and its rows."""

    file: str | None
    rows: int


class KeyedPut(DataSource):
    """Options: ``path`` (a folder all executors can reach), ``batch_id`` and ``key`` (a column)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return KeyedPutWriter(self.options["path"], int(self.options["batch_id"]), self.options["key"])


class KeyedPutWriter(DataSourceWriter):
    def __init__(self, path: str, batch_id: int, key: str):
        self.path, self.batch_id, self.key = path.rstrip("/"), batch_id, key
        self.staging = f"{self.path}/_staging/{batch_id}-{uuid.uuid4().hex}"

    def _store(self) -> tuple[fs.FileSystem, str]:
        """File system of the store, and what to cut from an address to get a place in it."""
        if "://" not in self.path and not self.path.startswith("file:"):
            return fs.LocalFileSystem(), ""
        store, place = fs.FileSystem.from_uri(self.path)
        return store, self.path[: len(self.path) - len(place)]

    def write(self, iterator: Iterator[Row]) -> Put:
        store, scheme = self._store()
        rows, out = 0, None
        name = f"{self.staging}/{uuid.uuid4().hex}.jsonl"
        try:
            for row in iterator:
                if row[self.key] is None:
                    raise ValueError(f"a row without {self.key} cannot be put")
                if out is None:
                    store.create_dir(self.staging.removeprefix(scheme))
                    out = store.open_output_stream(name.removeprefix(scheme))
                out.write((json.dumps(row.asDict(recursive=True), default=str, separators=(",", ":")) + "\n").encode())
                rows += 1
        finally:
            if out is not None:
                out.close()
        return Put(name if rows else None, rows)

    def commit(self, messages: list[Put | None]) -> None:
        store, scheme = self._store()
        target = f"{self.path}/batch_id={self.batch_id}".removeprefix(scheme)
        if store.get_file_info(target).type != fs.FileType.NotFound:
            store.delete_dir(target)
        store.create_dir(target)
        for put in messages:
            if put is not None and put.file is not None:
                store.move(put.file.removeprefix(scheme), f"{target}/{put.file.rsplit('/', 1)[-1]}")
        self._forget(store, scheme)

    def abort(self, messages: list[Put | None]) -> None:
        self._forget(*self._store())

    def _forget(self, store: fs.FileSystem, scheme: str) -> None:
        place = self.staging.removeprefix(scheme)
        if store.get_file_info(place).type != fs.FileType.NotFound:
            store.delete_dir(place)


def put_once(df: DataFrame, path: str, batch_id: int, key: str, order: Sequence[str]) -> None:
    """Put each key of a batch once: of several rows, the last one in ``order``. Rows without a key stop the batch."""
    spark = df.sparkSession
    spark.dataSource.register(KeyedPut)
    row = F.struct(*df.columns)
    last = df.groupBy(key).agg(F.max_by(row, F.struct(*order)).alias("_r")).select("_r.*")
    last.write.format(FORMAT).mode("append").option("path", path).option("batch_id", batch_id).option("key", key).save()


def read_store(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """The current row of every key: that of the newest batch."""
    fields = spark.createDataFrame([], schema).schema.names
    rows = spark.read.schema(f"{schema}, batch_id bigint").option("basePath", path).json(f"{path}/batch_id=*")
    return rows.groupBy(key).agg(F.max_by(F.struct(*fields), "batch_id").alias("_r")).select("_r.*")
