"""Training and scoring on MLlib: fraud forest, document classifier, engagement regressor."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.exprs import hash_fraction


def _inputs(features: Sequence[str], scale: bool = True) -> list:
    vector = VectorAssembler(inputCols=list(features), outputCol="features_raw" if scale else "features", handleInvalid="keep")
    return [vector, StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=True)] if scale else [vector]


def forest(features: Sequence[str], label: str, trees: int = 100, depth: int = 10, seed: int = 42) -> Pipeline:
    return Pipeline(stages=[*_inputs(features), RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)])


def boosted(features: Sequence[str], label: str, rounds: int = 50, depth: int = 8, seed: int = 42) -> Pipeline:
    return Pipeline(stages=[*_inputs(features), GBTClassifier(labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed)])


def positive_probability(model: PipelineModel, df: DataFrame, features: Sequence[str], out: str = "fraud_score") -> DataFrame:
    """Score rows; missing features count as 0."""
    scored = model.transform(df.fillna(0.0, list(features)))
    return scored.withColumn(out, vector_to_array("probability")[1])


def batch_predict(df: DataFrame, features: Sequence[str], load: Callable[[], Callable[[np.ndarray], np.ndarray]], out: str, batch: int = 4096) -> DataFrame:
    """Score rows with any Python model. ``load`` runs once per Python worker and returns a function from a batch of rows
    (float64, the features in the given order, missing ones 0) to one number per row."""
    score = predict_batch_udf(load, return_type=T.DoubleType(), batch_size=batch, input_tensor_shapes=[[len(features)]])
    whole = F.array(*(F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features))
    return df.withColumn(out, score(whole))


def binary_scores(scored: DataFrame, label: str) -> dict[str, float]:
    auc = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction")
    return {
        "auc_roc": auc.evaluate(scored),
        "auc_pr": auc.evaluate(scored, {auc.metricName: "areaUnderPR"}),
    }


def stratified_split(df: DataFrame, key: str, label: str, test: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Hash split inside every class: the seed of the hash is the class, so shares hold per class."""
    low = hash_fraction(F.concat_ws("/", F.col(label).cast("string"), F.col(key).cast("string")), "stratum") < test
    return df.filter(~low), df.filter(low)


def train_classifier(train: DataFrame, features: Sequence[str], label: str, trees: int = 50, depth: int = 6, seed: int = 42) -> PipelineModel:
    index = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="keep")
    return Pipeline(stages=[index, *_inputs(features, scale=False), RandomForestClassifier(labelCol="_label", numTrees=trees, maxDepth=depth, seed=seed)]).fit(train)


def classifier_scores(scored: DataFrame) -> dict[str, float]:
    e = MulticlassClassificationEvaluator(labelCol="_label", predictionCol="prediction")
    return {m: e.evaluate(scored, {e.metricName: m}) for m in ("accuracy", "f1", "weightedPrecision", "weightedRecall")}


def train_engagement(train: DataFrame, features: Sequence[str], label: str, rounds: int = 20, depth: int = 5, seed: int = 42) -> PipelineModel:
    return Pipeline(stages=[*_inputs(features, scale=False), GBTRegressor(labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed)]).fit(train.fillna(0.0, list(features)))


def rmse(scored: DataFrame, label: str) -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse").evaluate(scored)


def through_file(model: PipelineModel, path: str) -> PipelineModel:
    """Hand a trained model from the training job to the scoring job, without its training data."""
    save_model(model, path)
    return load_model(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
