import numpy as np
import pandas as pd
import pytest

from lakeops.operators import ranks


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    values = np.where(rng.random(3000) < 0.33, 7.0, np.round(rng.normal(size=3000), 2))  # a third share one value
    pdf = pd.DataFrame({"id": range(3000), "g": rng.choice(["a", "b", "c"], 3000, p=[0.8, 0.19, 0.01]), "v": values})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("ranges", [1, 7, 256])
def test_percentiles_per_key(frame, ranges):
    pdf, df = frame
    points = {"p10": 0.1, "p50": 0.5, "p99": 0.99, "p0": 0.0, "p100": 1.0}
    for row in ranks.exact_percentiles(df, ["g"], "v", points, ranges).collect():
        mine = pdf[pdf.g == row["g"]].v
        for name, p in points.items():
            assert row[name] == pytest.approx(np.quantile(mine, p))


def test_percent_rank_with_ties(frame):
    pdf, df = frame
    got = {r["id"]: r["pr"] for r in ranks.percent_rank(df, "v", "pr").collect()}
    want = (pdf.v.rank(method="min") - 1) / (len(pdf) - 1)
    assert all(got[i] == pytest.approx(want[i]) for i in pdf.id)


def test_percent_rank_with_nulls_and_one_row(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1.0), (4, 2.0)], "id int, v double")
    got = {r["id"]: r["pr"] for r in ranks.percent_rank(df, "v", "pr").collect()}
    assert got == {1: 0.0, 2: 0.0, 3: pytest.approx(2 / 3), 4: 1.0}
    assert ranks.percent_rank(df.filter("id = 3"), "v", "pr").first()["pr"] == 0.0
