"""Walks over job runs that are linked by the paths they write and read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.exprs import c
from lakeops.session import materialize


def normal_path(path: Column | str) -> Column:
    """One slash between parts and one at the end."""
    return F.regexp_replace(F.concat(c(path), F.lit("/")), "/+", "/")


def prefixes(path: Column) -> Column:
    """The path itself and every folder above it."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    lead = F.when(path.startswith("/"), "/").otherwise("")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(lead, F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))


def paths_of(runs: DataFrame, column: str) -> Column:
    """The normalised paths of a column that holds one path or a list of them."""
    value = F.col(column)
    many = value if isinstance(runs.schema[column].dataType, T.ArrayType) else F.array(value)
    return F.filter(F.transform(many, normal_path), lambda p: p.isNotNull())


def downstream(runs: DataFrame, start: Sequence, depth: int = 5, job: str = "job_execution_id", inputs: str = "input_path", outputs: str = "output_path") -> DataFrame:
    """Runs that read, directly or over up to ``depth`` hops, what the start runs wrote; a run has one path or a list.

    One hop is a distinct path list, a semi join with the readers and an anti join with
    what was seen already; each hop is written out before the next, and no path emits pairs.
    """
    reads = runs.select(job, F.explode(paths_of(runs, inputs)).alias("_read"))
    reads = materialize(reads.select(job, F.explode(prefixes(F.col("_read"))).alias("_path")))
    writes = runs.select(job, F.explode(paths_of(runs, outputs)).alias("_path"))
    frontier = runs.filter(F.col(job).isin(*start)).select(job).distinct()
    seen = frontier.withColumn("hop", F.lit(0))
    for hop in range(1, depth + 1):
        paths = writes.join(frontier, job, "left_semi").select("_path").distinct()
        reached = reads.join(paths, "_path", "left_semi").select(job).distinct()
        frontier = materialize(reached.join(seen.select(job), job, "left_anti"))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier.withColumn("hop", F.lit(hop)))
    return seen.filter(F.col("hop") > 0)


def history(runs: DataFrame, path: str, limit: int = 100, start=None, end=None, job: str = "job_execution_id", inputs: str = "input_path", outputs: str = "output_path") -> DataFrame:
    """Newest runs that read or wrote at or below ``path``."""
    root = normal_path(F.lit(path))
    touched = F.exists(F.concat(paths_of(runs, inputs), paths_of(runs, outputs)), lambda p: p.startswith(root))
    rows = runs.filter(touched)
    if start is not None:
        rows = rows.filter(F.col("start_time") >= F.lit(start))
    if end is not None:
        rows = rows.filter(F.col("start_time") <= F.lit(end))
    return rows.orderBy(F.desc("start_time"), job).limit(limit)
