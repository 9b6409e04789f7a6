"""Published sample cases and comparisons with the Python standard library."""

import hashlib
import hmac
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.functions import exprs
from lakeops.operators import binning, business, lineage, monitoring, privacy, quality, search, spatial, text, vectors
from lakeops.sources import scan, sinks
from lakeops.session import fresh_dir

T0 = datetime(2024, 1, 15, 8, 0)
GPS = "truck_id string, ts timestamp_ntz, seq bigint, latitude double, longitude double, speed_kmh double, engine_status string"


def gps(spark, rows):
    return spark.createDataFrame(rows, GPS)


def test_trip_of_five_fixes(spark):
    rows = [("TRK-001", T0 + timedelta(minutes=i), i, 40.0 + i * 0.001, -74.0, 40.0 + i, "running") for i in range(5)]
    trip = spatial.trip_stats(gps(spark, rows)).first()
    assert (trip["average_speed_kmh"], trip["max_speed_kmh"], trip["coordinates_count"]) == (42.0, 44.0, 5)
    assert 0.4 < trip["total_distance_km"] < 0.5


def test_idle_minutes_and_standing_still(spark):
    rows = [("T", T0 + timedelta(minutes=i), i, 40.0, -74.0, 0.0, "idle") for i in range(3)]
    trip = spatial.trip_stats(gps(spark, rows)).first()
    assert trip["idle_time_minutes"] == 2.0
    assert trip["total_distance_km"] == 0.0


FENCE = "geofence_id int, name string, geofence_type string, center_latitude double, center_longitude double, radius_meters double, alert_on string, vertices array<struct<lat:double,lon:double>>"


@pytest.mark.parametrize(
    ("alert_on", "path", "want"),
    [
        ("both", [(41.0, -74.0), (40.7128, -74.006)], ["enter"]),
        ("both", [(40.7128, -74.006), (41.0, -74.0)], ["exit"]),
        ("both", [(40.7128, -74.006), (40.7129, -74.006)], []),
        ("exit", [(41.0, -74.0), (40.7128, -74.006), (41.0, -74.0)], ["exit"]),
        ("enter", [(40.7128, -74.006), (41.0, -74.0)], []),
    ],
)
def test_fence_transitions(spark, alert_on, path, want):
    fence = spark.createDataFrame([(1, "GF-001", "circle", 40.7128, -74.006, 1000.0, alert_on, None)], FENCE)
    rows = [("T", T0 + timedelta(minutes=i), i, lat, lon, 0.0, "running") for i, (lat, lon) in enumerate(path)]
    got = spatial.geofence_alerts(gps(spark, rows), fence).orderBy("seq").collect()
    assert [r["alert_type"] for r in got] == want


def test_polygon_and_date_line(spark):
    square = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0)]
    fences = spark.createDataFrame(
        [(1, "p", "polygon", 0.5, 0.5, 0.0, "both", square), (2, "c", "circle", 10.0, 179.99, 5000.0, "both", None)], FENCE
    )
    points = gps(spark, [("T", T0, 0, 0.5, 0.5, 0.0, "x"), ("T", T0, 1, 1.5, 0.5, 0.0, "x"), ("T", T0, 2, 10.0, -179.99, 0.0, "x"), ("T", T0, 3, 10.0, -179.0, 0.0, "x")])
    hits = {(r["seq"], r["geofence_id"]) for r in spatial.points_in_fences(points, fences).collect()}
    assert hits == {(0, 1), (2, 2)}


def test_sms_rates_and_cost(spark):
    df = spark.createDataFrame([("_SMS.SUCCESS", 1000.0), ("_SMS.FAILURE", 1000.0), ("_SMS.BUFFERED", 1000.0)], "event_type string, price_millicents double")
    m = business.sms_metrics(df).first()
    assert (m["delivery_rate"], m["messages_sent"]) == (0.5, 2)
    assert m["total_cost_usd"] == pytest.approx(0.03)
    none = business.sms_metrics(df.limit(0)).first()
    assert (none["delivery_rate"], none["total_cost_usd"]) == (0.0, 0.0)


@pytest.mark.parametrize(("words", "want"), [("YES", "positive"), ("thanks!", "positive"), ("STOP", "negative"), ("no thanks", "negative"), ("What time?", "neutral")])
def test_reply_sentiment(spark, words, want):
    assert spark.range(1).select(business.reply_sentiment(F.lit(words)).alias("s")).first()["s"] == want


def test_tokens_match_the_standard_library(spark):
    values = ["4532-1234-5678-9012", "+41791234567", "ab", "", "Zoë-12"]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x string")
    out = df.select("x", privacy.deterministic_token("x", "s3cret").alias("d"), privacy.format_preserving_token("x", "s3cret", 4, 4).alias("f"), privacy.hash_token("x").alias("h")).collect()
    for r in out:
        if r["x"] is None:
            assert r["d"] is None and r["f"] is None and r["h"] is None
            continue
        assert r["d"] == hmac.new(b"s3cret", r["x"].encode(), hashlib.sha256).hexdigest()[:16]
        assert r["h"] == hashlib.sha256(r["x"].encode()).hexdigest()
    card = next(r["f"] for r in out if r["x"] == values[0])
    digest = hmac.new(b"s3cret", b"4532123456789012", hashlib.sha256).hexdigest().upper()
    assert card == f"4532-{digest[:4]}-{digest[4:8]}-9012"
    assert next(r["f"] for r in out if r["x"] == "ab") == "ab"


def test_masks(spark):
    row = spark.range(1).select(exprs.mask_all_but(F.lit("secret-1234")).alias("a"), exprs.mask_all_but(F.lit("abc")).alias("b")).first()
    assert (row["a"], row["b"]) == ("*******1234", "***")
    spans = F.array(F.struct(F.lit(3).alias("begin"), F.lit(8).alias("end"), F.lit("NAME").alias("entity_type")), F.struct(F.lit(12).alias("begin"), F.lit(13).alias("end"), F.lit("X").alias("entity_type")))
    assert spark.range(1).select(privacy.mask_spans(F.lit("Hi Alice at 5pm"), spans).alias("m")).first()["m"] == "Hi [NAME] at [X]pm"


def test_decryption_needs_the_same_context(spark):
    sealed = spark.range(1).select(privacy.encrypt_id(F.lit("p1"), F.lit("0123456789abcdef"), F.lit("f1")).alias("t"))
    assert sealed.select(privacy.decrypt_id("t", F.lit("0123456789abcdef"), F.lit("f1")).alias("p")).first()["p"] == "p1"
    with pytest.raises(Exception, match="(?i)aes|tag|crypt"):
        sealed.select(privacy.decrypt_id("t", F.lit("0123456789abcdef"), F.lit("f2")).alias("p")).collect()


def test_bins_have_one_label_each(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("a"))
    out = binning.percentile_bins(df, "a").groupBy("a_bin").count().collect()
    assert len(out) == 8 and "unknown" not in {r["a_bin"] for r in out}
    odd = spark.createDataFrame([(None,), (float("nan"),), (-5.0,), (5.0,)], "a double")
    labels = [r["a_bin"] for r in binning.custom_bins(odd, "a", [0.0, 10.0], ["neg", "pos"], negatives="keep").collect()]
    assert labels == ["unknown", "unknown", "neg", "pos"]
    with pytest.raises(Exception, match="negative value"):
        binning.handle_negatives(odd, "a", "error").collect()


def test_chunks(spark):
    body = ("A" * 890 + ". ") + "B" * 500
    assert list(text.chunk_spans(body)) == [(0, 892), (692, 1392)]
    assert list(text.chunk_spans("x" * 100)) == [(0, 100)]
    assert list(text.chunk_spans("")) == []
    # marks are tried in a fixed order: ". " wins over a later "! "
    body = "a" * 850 + ". " + "b" * 100 + "! " + "c" * 500
    assert next(text.chunk_spans(body)) == (0, 852)
    whole = "word " * 3000
    spans = list(text.chunk_spans(whole))
    assert spans[0][0] == 0 and all(b[0] < a[1] for a, b in zip(spans, spans[1:], strict=False)) and spans[-1][1] == len(whole)


def test_knn_in_several_blocks_and_with_ties(spark):
    df = spark.createDataFrame([(i, [1.0, float(i % 3)]) for i in range(30)], "vec_id bigint, embedding array<float>")
    queries = spark.createDataFrame([(q, [1.0, float(q)]) for q in range(3)], "query_id int, vector array<double>")
    one = vectors.knn_exact(df, queries, "vec_id", "embedding", "query_id", 4)
    many = vectors.knn_exact(df, queries, "vec_id", "embedding", "query_id", 4, block=1)
    as_set = lambda d: sorted((r["query_id"], r["rank"], r["vec_id"]) for r in d.collect())
    assert as_set(one) == as_set(many)
    assert [r[2] for r in as_set(one) if r[0] == 1] == [1, 4, 7, 10]


def test_foreign_embedding_model(spark):
    df = spark.createDataFrame([("a b",), (" ",), ("c",)], "t string")
    out = vectors.embed_with(df, "t", lambda texts: [[float(len(x)), 0.0] for x in texts], batch=1)
    assert sorted(r["embedding"][0] for r in out.collect()) == [1.0, 3.0]


def test_lineage_by_folder_prefix(spark):
    runs = spark.createDataFrame([(1, "/raw", "/a//b"), (2, "/a/b/day=1/", "/c/"), (3, "/a/bc/", "/d/"), (4, "/c", "/a/b")], "job_execution_id int, input_path string, output_path string")
    got = {(r["job_execution_id"], r["hop"]) for r in lineage.downstream(runs, [1], 5).collect()}
    assert got == {(2, 1), (4, 2)}


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame([("a", 1, "running", 46.0, 6.0, 50.0), (None, 2, "flying", 99.0, 6.0, -5.0)], "truck_id string, seq int, engine_status string, latitude double, longitude double, speed_kmh double")
    good, bad = quality.quarantine(df, quality.gps_rules(), "seq")
    assert [r["seq"] for r in good.collect()] == [1]
    row = bad.first()
    assert row["reason"].count(";") == 3 and '"seq":2' in row["body"]


def test_canary_reasons(spark):
    df = spark.createDataFrame([("canary", 500.0, 0.2, 10), ("production", 100.0, 0.01, 1000)], "variant_name string, latency_p99_ms double, error_rate double, invocation_count int")
    row = monitoring.canary_health(df, 100.0, 0.05).first()
    assert row["canary_unhealthy"] and row["reason"].count(";") == 3
    calm = spark.createDataFrame([("canary", 5.0, 0.0, 10), ("production", 100.0, 0.01, 1000)], df.schema)
    assert monitoring.canary_health(calm, 100.0, 0.05).first()["reason"] == "Healthy"


def test_paging_visits_every_row_once(spark):
    df = spark.createDataFrame([(i % 4, i) for i in range(25)], "a int, b int")
    seen, after = [], None
    while True:
        page = search.next_page(df, ["a", "b"], 7, after).collect()
        if not page:
            break
        seen += [(r["a"], r["b"]) for r in page]
        after = list(seen[-1])
    assert seen == sorted((i % 4, i) for i in range(25))


def test_missing_days_and_columns(spark):
    path = fresh_dir(spark, "t")
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 4))], "x int, date date")
    sinks.write_partitioned(df, path, ["date"])
    assert scan.scan_date_range(spark, path, "2024-01-04", 2).count() == 1
    csv = fresh_dir(spark, "c")
    df.write.option("header", True).csv(csv)
    with pytest.raises(ValueError, match="missing columns"):
        scan.scan_csv(spark, csv, "x int, y int", ["x", "y"])
    with pytest.raises(ValueError, match="cannot be written"):
        sinks.write_format(df, "parquet", csv, "lzo")
