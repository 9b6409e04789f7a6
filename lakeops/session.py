"""Where a job may keep files that every executor must be able to read."""

from __future__ import annotations

import pathlib
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="lakeops-", dir="/tmp")
    spark.conf.set(_SETTING, folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the shared one; ``clear_scratch`` deletes it."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch(spark).append(path)
    return path


def _scratch(spark: SparkSession) -> list[str]:
    sc = spark.sparkContext
    if not hasattr(sc, "_lakeops_scratch"):
        sc._lakeops_scratch = []
    return sc._lakeops_scratch


def clear_scratch(spark: SparkSession, since: int = 0) -> None:
    """Delete the folders made in this session (from number ``since`` on); call it when the results are stored."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folders = _scratch(spark)
    for path in folders[since:]:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    del folders[since:]


@contextmanager
def scratch(spark: SparkSession):
    """Intermediate folders made inside the block are deleted at its end, also after an error."""
    since = len(_scratch(spark))
    try:
        yield
    finally:
        clear_scratch(spark, since)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Session settings inside the block; at its end they are what they were before."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result has no history to recompute, survives lost executors and is columnar.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, whatever folder the driver runs in."""
    sc = spark.sparkContext
    if getattr(sc, "_lakeops_shipped", False):
        return
    package = pathlib.Path(__file__).parent
    target = pathlib.Path(tempfile.mkdtemp(prefix="lakeops-code-")) / "lakeops"
    sc.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
    sc._lakeops_shipped = True
