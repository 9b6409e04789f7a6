"""Rank metrics, profiles, sketches, percentiles and fences against plain Python."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.operators import ranks, scores, spatial
from lakeops.session import fresh_dir
from lakeops.sources import folders, keyed, scan, sinks

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice([0, 1, 1, None]), rng.choice([None, float("nan"), *[k / 7 for k in range(8)], 1e-9, 2e-9])) for _ in range(600)]
    return rows, spark.createDataFrame(rows, "g string, y int, s double")


def test_auc_and_curve(spark, judged, monkeypatch):
    monkeypatch.setattr(ranks, "PER_RANGE", 3)
    rows, df = judged
    got = {r["g"]: r for r in scores.auc(df, "y", "s", ["g"]).collect()}
    for g in "ab":
        known = [(y, s) for k, y, s in rows if k == g and y is not None and s is not None and s == s]
        p, n = [s for y, s in known if y], [s for y, s in known if not y]
        wins = sum((a > b) + (a == b) / 2 for a in p for b in n)
        assert got[g]["auc_roc"] == pytest.approx(wins / len(p) / len(n))
        assert got[g]["average_precision"] == pytest.approx(sum(sum(x >= s for x in p) / sum(x >= s for _, x in known) for s in p) / len(p))
        curve = {r["threshold"]: r for r in scores.pr_curve(df.filter(F.col("g") == g), "y", "s").collect()}
        assert set(curve) == {s for _, s in known}
        for s, r in curve.items():
            assert (r["tp"], r["fp"]) == (sum(x >= s for x in p), sum(x >= s for x in n))
    one_kind = scores.auc(df.filter("y = 1"), "y", "s").first()
    assert one_kind["auc_roc"] is None and scores.auc(df.limit(0), "y", "s").first()["positives"] is None


def test_class_report_and_errors(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), (None, "a"), ("b", None), ("a", "d")]
    got = {r["label"]: r for r in scores.class_report(spark.createDataFrame(pairs, "y string, p string"), "y", "p").collect()}
    assert (got["a"]["precision"], got["a"]["recall"], got["a"]["support"]) == (0.5, pytest.approx(1 / 3), 3)
    assert (got["d"]["precision"], got["d"]["support"], got[None]["support"]) == (0.0, 0, 6)
    assert got[None]["recall"] == pytest.approx((1 + 1 + 0) / 6)
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (None, 1.0)], "t double, p double")
    row = scores.errors_by(df, "t", "p").first()
    assert (row["rows"], row["rmse"], row["mae"], row["bias"], row["r2"]) == (2, pytest.approx(0.5**0.5), 0.5, 0.5, 0.5)


def test_column_profiles_within_their_bounds(spark):
    rng = np.random.default_rng(5)
    x = rng.lognormal(0, 2, 20_000)
    rows = [(float(v) if i % 10 else None, f"user{i % 3000}@example.org" if i % 4 else "10.0.0.1", None, i) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "x double, t string, empty double, id bigint").repartition(6)
    marks = (0.05, 0.5, 0.95)
    got = {r["column_name"]: r for r in scores.profile_columns(df, {"EMAIL": "[a-z0-9]+@[a-z]+[.]org"}, marks).collect()}
    known = np.sort([r[0] for r in rows if r[0] is not None])
    assert (got["x"]["rows"], got["x"]["missing"], got["x"]["low"], got["x"]["high"]) == (20_000, 2000, known[0], known[-1])
    assert got["x"]["mean"] == pytest.approx(known.mean()) and got["x"]["deviation"] == pytest.approx(known.std(ddof=1))
    for p, v in zip(marks, got["x"]["quantiles"], strict=True):
        assert abs(np.searchsorted(known, v) / len(known) - p) < 0.03
    assert got["t"]["personal"] == {"EMAIL": 15_000} and got["empty"]["missing"] == 20_000 and got["empty"]["quantiles"] is None
    for name, true in (("x", 18_000), ("t", len({r[1] for r in rows})), ("id", 20_000), ("empty", 0)):
        assert got[name]["distinct_about"] == pytest.approx(true, rel=0.05)
    pair = scores.correlations(df, ["x", "id"]).first()
    mask = [r for r in rows if r[0] is not None]
    assert pair["rows"] == 18_000 and pair["correlation"] == pytest.approx(np.corrcoef([r[0] for r in mask], [r[3] for r in mask])[0, 1])
    assert scores.correlations(df, ["x"]).collect() == []
    assert tuple(scores.duplicate_rows(df, ["t"]).first()) == (20_000, 20_000 - len({r[1] for r in rows}))


def test_stored_sketches_merge_over_any_range(spark):
    rng = random.Random(4)
    rows = [(T0 + timedelta(days=rng.randrange(10), minutes=i % 1000), f"u{rng.randrange(4000)}") for i in range(20_000)] + [(None, "u1"), (T0, None)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, user string")
    path = fresh_dir(spark, "t-sketches")
    scores.daily_sketches(df, "user").write.parquet(path)
    ranges = spark.createDataFrame([(i, (T0 + timedelta(days=i)).date(), (T0 + timedelta(days=j)).date()) for i, j in ((0, 0), (2, 5), (3, 40))], "range_id int, first_day date, last_day date")
    for r in scores.distinct_in_ranges(spark.read.parquet(path), ranges).collect():
        last = {0: 0, 2: 5, 3: 40}[r["range_id"]]
        inside = [(t, u) for t, u in rows if t and r["range_id"] <= (t.date() - T0.date()).days <= last]
        assert r["rows"] == len(inside)
        assert r["distinct_about"] == pytest.approx(len({u for _, u in inside if u}), rel=0.05)


def test_selected_percentiles_are_exact(spark):
    rng = np.random.default_rng(6)
    values = np.r_[rng.lognormal(0, 3, 3000), np.repeat([1.0, 2.0, 2.5], 900), -1e300, 1e300, 0.0]
    rng.shuffle(values)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)] * 5, "x double").repartition(5)
    points = [0.0, 0.001, 0.1, 0.25, 0.5, 0.63, 0.9, 0.999, 1.0]
    got = ranks.percentile_values(df, "x", points)
    assert got == pytest.approx([float(np.quantile(values, p)) for p in points])
    counted = ranks.bracketed(df, "x", [0.5], 0.005).count()
    assert counted < 200  # nothing but the neighbourhood of the median is counted value by value
    assert ranks.percentile_values(df.filter("x IS NULL"), "x", [0.5]) == [None]
    single = ranks.percentile_values(spark.createDataFrame([(3.0,), (math.inf,), (-math.inf,)], "x double"), "x", [0.0, 0.5, 1.0])
    assert single == [-math.inf, 3.0, math.inf]


FENCE = "geofence_id int, name string, geofence_type string, center_latitude double, center_longitude double, radius_meters double, alert_on string, vertices array<struct<lat:double,lon:double>>"


def test_fences_of_all_sizes(spark):
    rng = random.Random(8)
    fences = [(i, "c", "circle", rng.uniform(-89, 89), rng.uniform(-180, 180), 10 ** rng.uniform(0, 6.3), "both", None) for i in range(60)]
    fences += [(60, "c", "circle", 46.0, 7.0, 700_000.0, "both", None), (61, "c", "circle", 89.9, 10.0, 60_000.0, "both", None), (62, "c", "circle", 0.0, 179.9, 50_000.0, "both", None), (63, "c", "circle", 5.0, 5.0, 0.0, "both", None)]
    square = [(45.0, 5.0), (45.0, 10.5), (48.0, 10.5), (48.0, 5.0)]
    fences.append((64, "country", "polygon", 46.5, 7.75, 0.0, "both", square))
    df = spark.createDataFrame(fences, FENCE)
    cells = {r["geofence_id"]: r["n"] for r in spatial.fence_cells(df).groupBy("geofence_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(cells) == set(range(65)) and max(cells.values()) < 1000
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(600)]
    points += [(1000 + i, f[3] + rng.gauss(0, 1) * f[5] / 111_195, f[4] + rng.gauss(0, 1) * f[5] / 111_195) for i, f in enumerate(fences * 6)]
    points = [(i, max(-90.0, min(90.0, a)), (b + 180) % 360 - 180) for i, a, b in points] + [(5000, None, 1.0), (5001, 5.0, 5.0)]
    fixes = spark.createDataFrame(points, "seq bigint, latitude double, longitude double")
    got = {(r["seq"], r["geofence_id"]) for r in spatial.points_in_fences(fixes, df).collect()}

    def distance(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        return 2 * 6371000 * math.asin(min(1.0, math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2)))

    want = {(i, f[0]) for i, a, b in points if a is not None for f in fences if f[2] == "circle" and distance(a, b, f[3], f[4]) <= f[5]}
    want |= {(i, 64) for i, a, b in points if a is not None and 45 < a <= 48 and 5 < b <= 10.5}
    assert got == want
    assert spatial.points_in_fences(fixes, df.limit(0)).collect() == []


def test_keyed_put_is_repeatable(spark):
    path, schema = fresh_dir(spark, "t-store"), "k string, v bigint, at bigint"
    first = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 1)], schema).repartition(3)
    second = spark.createDataFrame([("b", 4, 5), ("c", 5, 5)], schema)
    for batch, rows in ((0, first), (1, second), (1, second), (0, first)):
        keyed.put_once(rows, path, batch, "k", ["at"])
    assert sorted(tuple(r) for r in keyed.read_store(spark, path, schema, "k").collect()) == [("a", 2, 2), ("b", 4, 5), ("c", 5, 5)]
    assert spark.read.schema(f"{schema}, batch_id bigint").json(f"{path}/batch_id=*").count() == 4
    with pytest.raises(Exception, match="without k"):
        keyed.put_once(spark.createDataFrame([(None, 1, 1), ("z", 1, 1)], schema), path, 2, "k", ["at"])
    assert {r["k"] for r in keyed.read_store(spark, path, schema, "k").collect()} == {"a", "b", "c"}


def test_changing_json_shapes(spark):
    texts = ['{"a": 1, "b": {"c": "x"}}', '{"a": "7", "b": {"c": null}}', '{"a": "no"}', "[1]", "{", None, '{"a": 1.5, "b": 3}', ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = scan.parse_variant(df, "t", {"a": ("$.a", "bigint", -1), "c": ("$.b.c", "string", "?")}).orderBy("i").collect()
    assert [(r["a"], r["c"], r["is_bad"]) for r in out] == [(1, "x", False), (7, "?", False), (-1, "?", False), (-1, "?", False), (-1, "?", True), (-1, "?", True), (out[6]["a"], "?", False), (-1, "?", True)]


def test_part_files_have_their_own_ids(spark):
    path = fresh_dir(spark, "t-parts")
    spark.createDataFrame([("one",), ("two",)], "text string").repartition(2, "text").write.text(path)
    spark.createDataFrame([("three",)], "text string").coalesce(1).write.text(f"{path}/below")
    files = scan.whole_documents(spark, path).collect()
    assert len({r["document_id"] for r in files}) == len(files) >= 2


def test_text_folders_are_named_as_partition_by_names_them(spark):
    rows = [("a/b=c", 1, "x\ny"), ("a/b=c", 2, None), (None, 3, "é"), ("", 3, "z"), ("it's %", 4, ""), ("a/b=c", 1, "twice"), ("ü [1]", None, "w")]
    df = spark.createDataFrame(rows, "lang string, id int, text string").repartition(3)
    plain, path = fresh_dir(spark, "t-plain"), fresh_dir(spark, "t-folders")
    df.coalesce(1).write.partitionBy("lang", "id").text(plain)
    folders.write_text_folders(df, path, ["lang", "id"], "text", rows=1)

    def told(root):
        files = scan.whole_documents(spark, root).collect()
        return sorted((r["address"].rsplit("/", 1)[0], sorted(r["text"].split("\n"))) for r in files)

    assert told(path) == told(plain)


def test_listing_many_folders_takes_few_tasks(spark):
    path = fresh_dir(spark, "t-many")
    folders.write_text_folders(spark.range(100).selectExpr("id", "CAST(id AS STRING) AS text"), path, ["id"], "text")
    spark.sparkContext.setJobGroup("t-many", "")
    try:
        files = scan.whole_documents(spark, path)
        jobs = [spark.sparkContext.statusTracker().getJobInfo(j) for j in spark.sparkContext.statusTracker().getJobIdsForGroup("t-many")]
        stages = [spark.sparkContext.statusTracker().getStageInfo(x) for j in jobs for x in j.stageIds]
        assert stages and max(x.numTasks for x in stages) <= 4 * spark.sparkContext.defaultParallelism
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert files.count() == 100


def test_catalog_counts_rows(spark):
    path, name = fresh_dir(spark, "t-catalog"), "t_counted"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.range(90).selectExpr("id", "CAST(id % 3 AS STRING) AS day")
    sinks.write_partitioned(df.filter("day < '2'"), path, ["day"])
    sinks.register_table(spark, name, path, "id bigint, day string", ["day"])
    sinks.write_partitioned(df.filter("day = '2'"), path, ["day"])
    assert spark.table(name).count() == 60
    sinks.add_partition(spark, name, day="2")
    sinks.analyze_table(spark, name)
    assert spark.table(name).count() == 90 and sinks.table_statistics(spark, name)["rows"] == 90
    sinks.analyze_table(spark, name, ["id"])
    spark.conf.set("spark.sql.cbo.enabled", True)  # the planner goes by the counted rows
    try:
        few = spark.table(name).filter("id < 9")._jdf.queryExecution().optimizedPlan().stats().rowCount().get()
        assert 5 <= int(str(few)) <= 15
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
    spark.sql(f"DROP TABLE {name}")
