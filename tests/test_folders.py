"""Folders of text, listed and read in tasks."""

import gzip
import pathlib

from pyspark.sql import functions as F

from lakeops.session import fresh_dir
from lakeops.sources import folders, scan


def test_no_list_of_files_is_held_by_the_driver(spark):
    path = fresh_dir(spark, "t-bounded")
    folders.write_text_folders(spark.range(100).selectExpr("id % 3 AS a", "id", "CAST(id AS STRING) AS text"), path, ["a", "id"], "text", rows=10)
    files = scan.whole_documents(spark, path)
    assert len(files.inputFiles()) < 50 and "FileScan text" not in files._jdf.queryExecution().executedPlan().toString()
    assert {(r["address"].rsplit("/", 1)[0], r["text"]) for r in files.collect()} == {(f"a={i % 3}/id={i}", f"{i}\n") for i in range(100)}


def test_files_read_in_tasks_are_those_that_spark_reads(spark, monkeypatch):
    monkeypatch.setattr(folders, "BATCH_ROWS", 2)
    path = fresh_dir(spark, "t-odd")
    root = pathlib.Path(path.removeprefix("file://").removeprefix("file:"))
    odd = {
        "a/empty.txt": b"", "a/bad.txt": b"a\xff\xfeb\n", "b%20c/\u00e9 n\u00a0.txt": "h\u00e9".encode(), "a/q[{|}]^`<>!$&()*+,;=@~.txt": b"q", "_hidden/x": b"h", "_k=1/x": b"k",
        ".dot": b"d", "x._COPYING_": b"c", "_SUCCESS": b"s", "part-00001-abc.txt": b"p", "crlf.txt": b"\xef\xbb\xbfa\r\n", "deep/1/2/3/nul": b"a\x00b",
    }
    for name, content in odd.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)

    def told(df):
        return sorted(tuple(r) for r in df.select("address", F.hex(F.col("text").cast("binary"))).collect())

    ours = scan._texts_by_tasks(spark, path)
    assert told(ours) == told(scan._texts_by_spark(spark, path)) and ours.count() == 7
    (root / "z.txt.gz").write_bytes(gzip.compress(b"zipped"))
    assert scan._texts_by_tasks(spark, path) is None
    assert "zipped" in {r["text"] for r in scan.whole_documents(spark, f"{path}/").collect()}
    assert scan._texts_by_tasks(spark, f"{path}/none") is None and scan._texts_by_tasks(spark, f"{path}/crlf.txt") is None
