"""Hot keys are cut into slices; the rows must not change."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.operators import anomaly, business, fraud, spatial
from lakeops.operators import timeline as tl

HOT = 0  # every key above zero rows and above its share of the table is hot
COLD = 10**9


@pytest.fixture(autouse=True)
def small_slices(monkeypatch):
    monkeypatch.setattr(tl, "SLICE_ROWS", 60)


@pytest.fixture(scope="module")
def txns(spark):
    """Skewed accounts, ties on the second, missing merchants, amounts and a null account."""
    rnd = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(900):
        account = 1 if i % 3 == 0 else rnd.choice([2, 3, 4, None])
        ts = start + timedelta(seconds=rnd.randrange(0, 40 * 86400, 600 if i % 2 else 7200), microseconds=rnd.choice([0, 0, 250000]))
        merchant = rnd.choice(["m1", "m2", "m3", None])
        amount = None if i % 50 == 0 else round(rnd.uniform(1, 500), 2)
        rows.append((i, account, merchant, f"d{rnd.randrange(3)}", "POS", "PURCHASE", amount, ts, 46 + rnd.random(), 6 + rnd.random(), "CH"))
    schema = (
        "transaction_id bigint, account_id bigint, merchant_id string, device_id string, channel string, transaction_type string, "
        "amount double, ts timestamp_ntz, location_lat double, location_lon double, location_country string"
    )
    return spark.createDataFrame(rows, schema)


def rows_of(df, digits=6):
    names = sorted(df.columns)
    fix = lambda v: round(v, digits) + 0.0 if isinstance(v, float) else v
    return sorted(tuple(str(fix(r[n])) for n in names) for r in df.collect())


@pytest.mark.parametrize("operator", [fraud.fraud_features, fraud.velocity_features, fraud.statistical_features, fraud.distance_features, fraud.behavioral_features, fraud.fraud_features_ext])
def test_hot_and_cold_plans_agree(txns, operator):
    assert rows_of(operator(txns, floor=HOT)) == rows_of(operator(txns, floor=COLD))


def test_windows_match_brute_force(txns):
    got = {r["transaction_id"]: r for r in fraud.fraud_features(txns.filter("account_id IS NOT NULL"), floor=HOT).collect()}
    data = [r for r in txns.collect() if r["account_id"] is not None]
    sec = lambda r: int((r["ts"] - datetime(1970, 1, 1)).total_seconds())
    for r in data[::13]:
        mine = [x for x in data if x["account_id"] == r["account_id"]]
        within = [x["amount"] for x in mine if sec(r) - 3600 <= sec(x) <= sec(r)]
        hour = [x for x in within if x is not None]
        month = [x["amount"] for x in mine if sec(r) - 2592000 <= sec(x) < sec(r) and x["amount"] is not None]
        row = got[r["transaction_id"]]
        assert row["tx_count_1h"] == len(within)
        assert row["tx_amount_1h"] == pytest.approx(sum(hour))
        mean = sum(month) / len(month) if month else 0.0
        assert row["avg_amount_30d"] == pytest.approx(mean)
        if len(month) > 1:
            var = sum((x - mean) ** 2 for x in month) / (len(month) - 1)
            assert row["std_amount_30d"] == pytest.approx(var**0.5)
        else:
            assert row["std_amount_30d"] == 1.0


def test_zero_spread_gives_zero_score(spark):
    rows = [(i, 1, "m", "d", "POS", "PURCHASE", 10.1, datetime(2024, 1, 1, 0, i), 46.0, 6.0, "CH") for i in range(6)]
    df = spark.createDataFrame(rows, "transaction_id bigint, account_id bigint, merchant_id string, device_id string, channel string, transaction_type string, amount double, ts timestamp_ntz, location_lat double, location_lon double, location_country string")
    out = fraud.statistical_features(df).orderBy("transaction_id").collect()
    # no history, then one value (default deviation 1), then equal values
    assert [r["std_amount_30d"] for r in out] == [1.0, 1.0, 0.0, 0.0, 0.0, 0.0]
    assert [r["amount_zscore"] for r in out] == [pytest.approx(10.1), 0.0, 0.0, 0.0, 0.0, 0.0]
    first = fraud.distance_features(df).orderBy("transaction_id").first()
    assert first["distance_from_last"] is None and first["time_since_last"] is None


def test_sequence_features_agree(txns):
    run = lambda floor: rows_of(anomaly.sequence_features(txns, ["account_id"], ["ts", "transaction_id"], "amount", history=5, floor=floor))
    assert run(HOT) == run(COLD)


def test_running_balance_agrees(txns):
    df = txns.select("transaction_id", F.col("account_id").cast("string").alias("source_account"), "transaction_type", F.when(F.col("transaction_id") % 3 != 0, F.col("amount")).alias("amount"), "ts")
    hot, cold = business.account_balances(df, floor=HOT), business.account_balances(df, floor=COLD)
    assert hot.schema == cold.schema
    assert rows_of(hot) == rows_of(cold)


def test_small_deposits_keep_all_decimals(spark):
    rows = [(i, "A", "DEPOSIT", "0.00000003", datetime(2024, 1, 1, 0, i)) for i in range(6)] + [(10, "B", "DEPOSIT", "0.00000001", datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "transaction_id bigint, source_account string, transaction_type string, amount string, ts timestamp_ntz").withColumn("amount", F.col("amount").cast("decimal(28,8)"))
    for floor in (HOT, COLD, 3):
        out = business.account_balances(df, floor=floor)
        assert out.schema["balance"].dataType.simpleString() == "decimal(38,8)"
        assert {r["transaction_id"]: int(r["balance"] * 10**8) for r in out.collect()} == {**{i: 3 * (i + 1) for i in range(6)}, 10: 1}


def test_trips_agree(txns):
    gps = txns.select(F.col("account_id").alias("truck_id"), "ts", F.col("transaction_id").alias("seq"), F.col("location_lat").alias("latitude"), F.col("location_lon").alias("longitude"), F.lit(10.0).alias("speed_kmh"), F.when(F.col("transaction_id") % 4 == 0, "idle").otherwise("running").alias("engine_status"))
    assert rows_of(spatial.trip_stats(gps, floor=HOT), 5) == rows_of(spatial.trip_stats(gps, floor=COLD), 5)


def test_hot_key_list_is_bounded_by_share(txns):
    hot = [r[0] for r in tl.hot_keys(txns, ["account_id"], floor=250).collect()]
    assert hot == [1]


def test_empty_input(txns):
    assert fraud.fraud_features(txns.limit(0)).count() == 0


def test_tiny_and_huge_amounts(spark):
    """Amounts keep their value next to others of any size, and none of them stops the job."""
    amounts = [0.00004, 0.00002, None, 1e12, 0.00004, 1e12 + 2, 3e15, 0.5]
    rows = [(i, 1, "m", "d", "POS", "PURCHASE", a, datetime(2024, 1, 1) + timedelta(days=20 * i), 46.0, 6.0, "CH") for i, a in enumerate(amounts)]
    rows += [(100 + i, 2, "m", "d", "POS", "PURCHASE", a, datetime(2024, 1, 1, 0, 0, i), 46.0, 6.0, "CH") for i, a in enumerate(amounts[:6])]
    df = spark.createDataFrame(rows, "transaction_id bigint, account_id bigint, merchant_id string, device_id string, channel string, transaction_type string, amount double, ts timestamp_ntz, location_lat double, location_lon double, location_country string")
    for floor in (HOT, COLD):
        got = {r["transaction_id"]: r for r in fraud.fraud_features(df, floor=floor).collect()}
        assert got[1]["avg_amount_30d"] == pytest.approx(0.00004) and got[2]["avg_amount_30d"] == pytest.approx(0.00002)
        assert got[5]["avg_amount_30d"] == pytest.approx(0.00004)  # the huge amount has left without a trace
        assert got[103]["std_amount_30d"] == pytest.approx(0.00002 / 2**0.5)
        assert [got[100 + i]["tx_count_1h"] for i in range(6)] == [1, 2, 3, 4, 5, 6]
        assert got[105]["tx_amount_1h"] == pytest.approx(2e12 + 2.0001)


def test_one_moment_is_divided(spark):
    """Rows of one timestamp are cut by their unique id."""
    df = spark.range(500).selectExpr("id", "1 AS k", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts", "CASE WHEN id % 2 = 0 THEN CAST(id AS DOUBLE) END AS x")
    cut = tl.with_slice(df, ["k"], ["ts", "id"])
    assert cut.groupBy("_slice").count().count() > 3
    run = lambda floor: rows_of(tl.running_totals(df, ["k"], ["ts", "id"], {"total": F.col("x")}, floor))
    assert run(HOT) == run(COLD)


def test_tasks_of_ordinary_keys_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(tl, "TASK_ROWS", 50)
    rows = spark.range(2000).selectExpr("id", "id % 100 AS k", "timestamp_seconds(id) AS ts")
    out = tl.previous_row(rows, ["k"], ["ts", "id"], {"id": "before"})
    assert out.rdd.getNumPartitions() == 40
    assert out.filter("before = id - 100").count() == 1900
