"""Streams return what their batch twins return, in any order within a batch and across restarts."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.operators import fraud, idempotency, search, spatial
from lakeops.operators import timeline as tl
from lakeops.streaming import jobs, run, state

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def gps(spark):
    rnd = random.Random(11)
    rows = [(rnd.randrange(3), T0 + timedelta(minutes=i), i, 46 + rnd.random() / 5, 6 + rnd.random() / 5, 20.0, "idle" if i % 4 == 0 else "running") for i in range(240)]
    return spark.createDataFrame(rows, "truck_id bigint, ts timestamp_ntz, seq bigint, latitude double, longitude double, speed_kmh double, engine_status string")


@pytest.fixture(scope="module")
def fence(spark):
    rows = [(i, f"f{i}", "circle", 46.05 + i * 0.03, 6.05 + i * 0.03, 4000.0, "both", None) for i in range(4)]
    return spark.createDataFrame(rows, "geofence_id bigint, name string, geofence_type string, center_latitude double, center_longitude double, radius_meters double, alert_on string, vertices array<struct<lat:double,lon:double>>")


def three(df, column="seq", cuts=(80, 160)):
    """Slices in order; rows inside a slice are shuffled."""
    c = F.col(column)
    parts = [df.filter(c < cuts[0]), df.filter((c >= cuts[0]) & (c < cuts[1])), df.filter(c >= cuts[1])]
    return [p.orderBy(F.xxhash64(column)) for p in parts]


def collect_stream(spark, parts, build, label, mode="append"):
    seen = {}

    def writer(stream, folder):
        out = build(stream)
        seen["schema"] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
        return run.to_folder(out, folder, mode)

    folder = run.replay(parts, writer, label)
    return run.read_batches(spark, folder, f"{seen['schema']}, batch_id bigint")


def test_latest(spark, gps):
    out = run.last_values(collect_stream(spark, three(gps), jobs.latest_positions, "t-latest", "update"), ["truck_id"])
    want = search.latest_per_key(gps, ["truck_id"], ["ts", "seq"])
    assert sorted((r["truck_id"], r["seq"]) for r in out.collect()) == sorted((r["truck_id"], r["seq"]) for r in want.collect())


def test_geofence(spark, gps, fence):
    out = collect_stream(spark, three(gps), lambda s: jobs.geofence_transitions(s, fence), "t-fence")
    pick = lambda df: sorted((r["seq"], r["geofence_id"], r["alert_type"]) for r in df.collect())
    assert pick(out) == pick(spatial.geofence_alerts(gps, fence))


def test_late_rows_are_marked_not_lost(spark, gps):
    parts = [gps.filter("seq >= 100"), gps.filter("seq < 100")]
    out = collect_stream(spark, parts, lambda s: state.previous_in_stream(s, "truck_id", "ts", "seq", {"seq": "before"}), "t-late")
    assert out.count() == 240
    assert {r["seq"] for r in out.filter("late").collect()} == set(range(100))


def test_dedup(spark):
    rnd = random.Random(5)
    rows = [(i, f"k{rnd.randrange(8)}", T0 + timedelta(hours=i), rnd.random() < 0.2) for i in range(240)]
    df = spark.createDataFrame(rows, "id bigint, key string, ts timestamp_ntz, failed boolean")
    out = collect_stream(spark, three(df, "id"), lambda s: state.accept_once_in_stream(s, "key", "ts", "id", F.col("failed")), "t-dedup")
    want = idempotency.accept_once(df, "key", "ts", "id", F.col("failed"))
    assert sorted((r["id"], r["accepted"]) for r in out.collect()) == sorted((r["id"], r["accepted"]) for r in want.collect())


def test_account_features(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.choice([1, 2]), rnd.choice(["m1", "m2", None]), "d", "POS", "PURCHASE", rnd.choice([None, 1e-6, 3e-6, 2e12, round(rnd.uniform(1, 90), 2), round(rnd.uniform(1, 90), 2)]), T0 + timedelta(minutes=20 * i), 46.0, 6.0 + rnd.random(), "CH") for i in range(240)]
    df = spark.createDataFrame(rows, "transaction_id bigint, account_id bigint, merchant_id string, device_id string, channel string, transaction_type string, amount double, ts timestamp_ntz, location_lat double, location_lon double, location_country string")
    out = collect_stream(spark, three(df, "transaction_id"), jobs.fraud_vectors, "t-velocity")
    got = {r["transaction_id"]: r for r in out.collect()}
    for r in fraud.fraud_features(df).collect():
        for name in fraud.FEATURES:
            want, mine = r[name], got[r["transaction_id"]][name]
            assert mine is None if want is None else mine == pytest.approx(want, rel=1e-9, abs=1e-12), name


@pytest.fixture(scope="module")
def payments(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.randrange(6), rnd.choice(["m1", "m2", "m3", None]), "d", rnd.choice([None, 7.25, 2e12, round(rnd.uniform(1, 90), 2)]), T0 + timedelta(minutes=50 * (i // 2)), rnd.choice([None, 46.0]), 6.0 + rnd.random()) for i in range(300)]
    return spark.createDataFrame(rows, "transaction_id bigint, account_id bigint, merchant_id string, device_id string, amount double, ts timestamp_ntz, location_lat double, location_lon double")


def test_accounts_that_share_a_group_stay_apart(spark, payments):
    parts = three(payments, "transaction_id")
    late = parts[2].limit(3).withColumns({"ts": F.expr("ts - INTERVAL 20 DAYS"), "transaction_id": F.col("transaction_id") + 1000})
    parts[2] = parts[2].unionByName(late)
    alone, shared = (collect_stream(spark, parts, lambda s, n=n: state.velocity_in_stream(s, groups=n), f"t-groups-{n}").drop("batch_id") for n in (4096, 1))
    told = lambda df: sorted(str([r[c] for c in sorted(df.columns)]) for r in df.collect())
    assert told(shared) == told(alone) and shared.filter("late").count() == 3
    rows = payments.withColumns({c: F.lit(None).cast("string") for c in ("channel", "transaction_type", "location_country")})
    want = {r["transaction_id"]: r for r in fraud.fraud_features(rows).collect()}
    for r in shared.filter("NOT late").collect():
        mine = want[r["transaction_id"]]
        for name in ("tx_count_1h", "tx_count_24h", "tx_amount_24h", "avg_amount_30d", "std_amount_30d", "is_new_merchant", "is_new_device"):
            assert r[name] == pytest.approx(mine[name], rel=1e-9, abs=1e-12), name


def test_a_silent_account_of_a_group_is_forgotten(spark, payments):
    last = T0 + timedelta(minutes=50 * 149)
    again = payments.filter("account_id = 0").limit(1)
    at = lambda days, i, account: again.withColumns({"ts": F.lit(last + timedelta(days=days)).cast("timestamp_ntz"), "transaction_id": F.lit(i).cast("bigint"), "account_id": F.lit(account).cast("bigint")})
    parts = [payments, at(0.9, 1000, 1), at(1.5, 1001, 1), at(1.6, 1002, 0).unionByName(at(1.6, 1003, 1))]
    out = {r["transaction_id"]: r for r in collect_stream(spark, parts, lambda s: state.velocity_in_stream(s, keep_days=1, groups=1), "t-quiet").collect()}
    assert out[1002]["tx_count_24h"] == 1 and out[1002]["is_new_device"] == 1 and out[1002]["prev_us"] is None
    assert out[1003]["is_new_device"] == 0 and out[1003]["prev_us"] is not None


def test_silent_trucks_are_forgotten(spark, gps):
    """A truck that is silent for a day starts anew; the others go on."""
    later = gps.filter("truck_id = 0 AND seq >= 200").limit(1).withColumn("ts", F.expr("ts + INTERVAL 30 HOURS"))
    clock = gps.filter("truck_id = 1").limit(1).withColumns({"ts": F.expr("ts + INTERVAL 29 HOURS"), "seq": F.lit(1000).cast("bigint")})
    build = lambda s: state.previous_in_stream(s, "truck_id", "ts", "seq", {"seq": "before"}, keep_days=1)
    quiet = gps.filter("seq < 120")
    out = collect_stream(spark, [quiet, clock, later.unionByName(clock.withColumn("seq", F.lit(1001).cast("bigint")))], build, "t-silent")
    rows = {(r["truck_id"], r["seq"]): r for r in out.collect()}
    again = next(r for (truck, seq), r in rows.items() if truck == 0 and seq >= 200)
    assert again["before"] is None and not again["late"]
    assert rows[1, 1001]["before"] == 1000


def test_trips_lose_nothing(spark, gps):
    """Windows of two hours with a slice that comes too late: every fix is in a window or comes out as late."""
    early, late = gps.filter("seq < 160"), gps.filter("seq >= 60 AND seq < 90")
    parts = [early.join(late, "seq", "left_anti").select(gps.columns), gps.filter("seq >= 160"), late, run.closing_row(gps, "ts", "1 DAY")]
    out = collect_stream(spark, parts, lambda s: jobs.trip_windows(s, 7200, "10 minutes"), "t-trips")
    trips, missed = jobs.trips_of(out), jobs.late_fixes_of(out)
    assert {r["seq"] for r in missed.collect()} == set(range(60, 90))
    assert trips.agg(F.sum("coordinates_count")).first()[0] == 210
    on_time = gps.join(late, "seq", "left_anti").select(gps.columns)
    want = {(r["truck_id"], str(r["window_start"])): r for r in spatial.trip_aggregate(
        spatial.segments_of(tl.previous_row(on_time, ["truck_id"], ["ts", "seq"], {"latitude": "_lat", "longitude": "_lon", "ts": "_ts"})),
        ["truck_id", F.window(F.col("ts").cast("timestamp"), "2 hours")["start"].cast("timestamp_ntz").alias("window_start")],
    ).collect()}
    got = {(r["truck_id"], str(r["window_start"])): r for r in trips.collect()}
    assert got.keys() == want.keys()
    for k, r in want.items():
        for name in ("total_distance_km", "average_speed_kmh", "max_speed_kmh", "idle_time_minutes", "coordinates_count"):
            assert got[k][name] == pytest.approx(r[name]), name


def test_late_repeats_are_judged_too(spark):
    """Rows far behind the clock come out of the idempotency rule like all others."""
    rows = [(i, f"k{i % 3}", T0 + timedelta(days=i), False) for i in range(30)]
    df = spark.createDataFrame(rows, "id bigint, key string, ts timestamp_ntz, failed boolean")
    out = collect_stream(spark, [df.filter("id >= 20"), df.filter("id < 20")], lambda s: state.accept_once_in_stream(s, "key", "ts", "id", F.col("failed")), "t-behind")
    assert sorted(r["id"] for r in out.collect()) == list(range(30))


def test_failed_batches_stop_the_stream(spark, gps):
    def broken(batch):
        raise ValueError("no model")

    with pytest.raises(Exception, match="no model"):
        run.replay([gps], lambda s, f: jobs.score_batches(s, broken, f), "t-broken")


def test_unreadable_rows_are_kept(spark):
    df = spark.createDataFrame([('{"id": 1}',), ("oops",)], "body string")
    out = collect_stream(spark, [df], lambda s: run.parse_events(s, "body", "id bigint", "id").drop("arrived_at"), "t-parse")
    assert sorted((r["id"] or 0, r["is_bad"], r["raw"] or "") for r in out.collect()) == [(0, True, "oops"), (1, False, "")]


def test_cheap_dedup_keeps_one_row_per_key(spark):
    df = spark.createDataFrame([(i, f"k{i % 4}", T0 + timedelta(minutes=i)) for i in range(40)], "id bigint, key string, ts timestamp_ntz")
    out = collect_stream(spark, [df], lambda s: jobs.dedup_cheap(s, "key", "ts"), "t-cheap")
    assert out.count() == 4


def test_keys_that_share_a_group_stay_apart(spark):
    rows = spark.range(300).selectExpr("id", "concat('k', id % 50) AS key", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, id) AS ts", "id % 7 = 0 AS failed")
    want = idempotency.accept_once(rows, "key", "ts", "id", failed=F.col("failed"))
    parts = [rows.filter("id < 100"), rows.filter("id BETWEEN 100 AND 199"), rows.filter("id >= 200")]
    got = collect_stream(spark, parts, lambda s: state.accept_once_in_stream(s, "key", "ts", "id", F.col("failed"), groups=2), "t-groups")
    assert {(r["id"], r["accepted"]) for r in got.collect()} == {(r["id"], r["accepted"]) for r in want.collect()}
