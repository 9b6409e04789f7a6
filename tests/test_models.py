import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeops.operators import anomaly, models
from lakeops.session import fresh_dir


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 2))
    pdf = pd.DataFrame({"id": range(400), "a": x[:, 0], "b": x[:, 1], "y": (x[:, 0] > 0.5).astype(int), "c": np.where(x[:, 1] > 0, "p", "q")})
    return spark.createDataFrame(pdf)


def test_saved_forest_scores_like_the_trained_one(spark, rows):
    model = models.forest(["a", "b"], "y", trees=5, depth=3).fit(rows)
    back = models.through_file(model, fresh_dir(spark, "model"))
    score = lambda m: [r["fraud_score"] for r in models.positive_probability(m, rows, ["a", "b"]).orderBy("id").collect()]
    assert score(model) == score(back)
    measured = models.binary_scores(back.transform(rows), "y")
    assert measured["auc_roc"] > 0.95 and measured["auc_pr"] > 0.9


def test_classifier_regressor_and_split(rows):
    train, test = models.stratified_split(rows, "id", "c")
    assert train.count() + test.count() == 400 and 40 < test.count() < 120
    scored = models.train_classifier(train, ["a", "b"], "c", trees=5, depth=3).transform(test)
    assert models.classifier_scores(scored)["accuracy"] > 0.9
    fit = models.train_engagement(rows, ["a", "b"], "a", rounds=5, depth=3)
    assert models.rmse(fit.transform(rows), "a") < 0.5


def test_isolation_forest_finds_the_outlier(spark, rows):
    odd = spark.createDataFrame([(999, 12.0, -12.0)], "id bigint, a double, b double")
    out = anomaly.isolation_forest(rows.select("id", "a", "b").unionByName(odd), "id", ["a", "b"], trees=50, sample=256)
    # rows at the rim of the cloud come close, because a tree that did not draw the outlier cannot tell them apart
    assert 999 in [r["id"] for r in out.orderBy(F.desc("isolation_score")).take(3)]
    assert out.count() == 401
