import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.operators.idempotency import accept_once


def brute_force(rows):
    accepted, state = set(), {}
    for row_id, key, ts, failed in sorted(rows, key=lambda r: (r[2], r[0])):
        last, free = state.get(key, (None, True))
        if free or ts - last > timedelta(days=1):
            accepted.add(row_id)
            state[key] = (ts, failed)
    return accepted


@pytest.mark.parametrize("fold_rows", [10_000, 0, 60])
def test_matches_brute_force(spark, fold_rows):
    rnd = random.Random(3)
    base = datetime(2024, 1, 1)
    rows = [
        (i, "hot" if i % 3 == 0 else f"k{rnd.randrange(20)}", base + timedelta(minutes=rnd.randrange(0, 20 * 1440, 360)), rnd.random() < 0.2)
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "id bigint, key string, ts timestamp_ntz, failed boolean")
    out = accept_once(df, "key", "ts", "id", F.col("failed"), fold_rows=fold_rows)
    assert {r["id"] for r in out.filter("accepted").collect()} == brute_force(rows)
    assert out.count() == len(rows)


def test_exactly_one_day_is_still_a_repeat(spark):
    t = datetime(2024, 1, 1)
    rows = [(1, "a", t, False), (2, "a", t + timedelta(days=1), False), (3, "a", t + timedelta(days=1, microseconds=1), False)]
    df = spark.createDataFrame(rows, "id bigint, key string, ts timestamp_ntz, failed boolean")
    for fold_rows in (10, 0):
        out = accept_once(df, "key", "ts", "id", F.col("failed"), fold_rows=fold_rows)
        assert sorted(r["id"] for r in out.filter("accepted").collect()) == [1, 3]
