"""Sums of doubles that do not depend on the order of rows."""

import datetime as dt

from pyspark.sql import functions as F

from lakeops.functions.exprs import exact_sum
from lakeops.operators import business


def test_exact_sum(spark):
    groups = {1: [0.1] * 10, 2: [1e300, 1.0], 3: [float("nan"), 1.0], 4: [None, None], 5: [None, 0.25], 6: [float("inf"), 1.0], 7: [-0.3, 0.1, 0.2]}
    rows = spark.createDataFrame([(k, v) for k, values in groups.items() for v in values], "k int, v double")
    got = {r["k"]: r["s"] for r in rows.groupBy("k").agg(exact_sum("v").alias("s")).collect()}
    assert got[1] == 1.0 and got[2] == 1e300 and got[3] != got[3] and got[4] is None and got[5] == 0.25 and got[6] == float("inf") and got[7] == 0.0


def test_user_features_have_exact_totals(spark):
    day = dt.datetime(2024, 1, 20)
    views = spark.createDataFrame([(1, i, i % 2, 0.1, 0.1, day) for i in range(10)], "user_id int, event_id int, content_id int, watch_time double, completion_rate double, ts timestamp_ntz")
    content = spark.createDataFrame([(0, "a"), (1, "b")], "content_id int, genre string")
    one = business.user_features(views, content, "2024-01-31").first()
    assert (one["total_watch_time"], one["avg_watch_time"], one["avg_completion_rate"]) == (1.0, 0.1, 0.1)
    assert business.genre_shares(views, content).agg(F.sum("user_time")).first()[0] == 2.0
