"""Named queries and, where SQL can say the same thing, their oracle text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeops.fixtures import VIEWS, Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the fixture views it mentions, as common table expressions."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    ctes = ",\n".join(f"{v} AS ({VIEWS[v].format_map(_Bare())})" for v in used)
    body = sql.strip()
    if not ctes:
        return body
    recursive = re.match(r"(?is)with\s+(recursive\s+)?", body)
    if recursive:
        word = "WITH RECURSIVE" if recursive.group(1) else "WITH"
        return f"{word} {ctes},\n{body[recursive.end():]}"
    return f"WITH {ctes}\n{body}"


class _Bare(dict):
    def __missing__(self, key: str) -> str:
        return key


def query(name: str, oracle: str | None = None):
    """Register ``fn(lake) -> DataFrame`` under ``name``; ``oracle`` is its DuckDB twin."""

    def register(fn: Callable[[Lake], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Lake(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = with_views(oracle)
        return fn

    return register
