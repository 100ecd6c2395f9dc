"""Models over prepared columns: class prior, multinomial logistic regression and one-against-rest boosted trees.

Medians fill what is missing, with a flag per column; columns are standardised for the regression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .evaluate import FIT_ROWS, uniform_sample


def flagged(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """rows with <feature>_missing: 1 where it is null or not a number."""
    return rows.withColumns({f"{c}_missing": (F.col(c).isNull() | F.isnan(c)).cast("double") for c in features})


def _steps(features: Sequence[str], scale: bool) -> list:
    filled = [f"{c}_filled" for c in features]
    steps = [Imputer(strategy="median", inputCols=list(features), outputCols=filled), VectorAssembler(inputCols=[*filled, *(f"{c}_missing" for c in features)], outputCol="raw_features")]
    return [*steps, StandardScaler(withMean=True, inputCol="raw_features", outputCol="features")] if scale else steps


def fit_logistic(rows: DataFrame, features: Sequence[str], y: str, c: float = 0.1, iterations: int = 100, order: Sequence[str] = (), most: int = FIT_ROWS, classes: int = 3) -> PipelineModel:
    """order: columns of time; with them at most `most` rows are learnt from, at equally spaced places, each class among them."""
    rows = uniform_sample(rows, order, most, y, classes) if order else rows
    n = max(1, rows.count())
    model = LogisticRegression(family="multinomial", featuresCol="features", labelCol=y, regParam=1.0 / (c * n), maxIter=iterations)
    return Pipeline(stages=[*_steps(features, True), model]).fit(flagged(rows, features))


def predict_logistic(model: PipelineModel, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """rows with probabilities (array of the classes')."""
    return model.transform(flagged(rows, features)).select(*rows.columns, vector_to_array("probability").alias("probabilities"))


def fit_boosted(rows: DataFrame, features: Sequence[str], y: str, classes: int, trees: int = 20, depth: int = 4) -> list[PipelineModel]:
    """One binary model of boosted trees per class."""
    prepared = flagged(rows, features)
    out = []
    for k in range(classes):
        labelled = prepared.withColumn("_y", (F.col(y) == k).cast("double"))
        out.append(Pipeline(stages=[*_steps(features, False), GBTClassifier(featuresCol="raw_features", labelCol="_y", maxIter=trees, maxDepth=depth, seed=7)]).fit(labelled))
    return out


def predict_boosted(models: list[PipelineModel], rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """rows with probabilities: the models' own, scaled to sum 1."""
    out = flagged(rows, features)
    made = ["raw_features", "rawPrediction", "probability", "prediction", *(f"{c}_filled" for c in features)]
    for k, model in enumerate(models):
        out = model.transform(out).withColumn(f"_p{k}", F.element_at(vector_to_array("probability"), 2)).drop(*made)
    whole = sum((F.col(f"_p{k}") for k in range(1, len(models))), start=F.col("_p0"))
    return out.select(*rows.columns, F.array(*(F.col(f"_p{k}") / whole for k in range(len(models)))).alias("probabilities"))


def freeze(path: str, model: PipelineModel, parameters: dict) -> None:
    """Saves a fitted model with its calibration and estimates; what is there stays as it is."""
    import json

    model.write().save(f"{path}/model")
    SparkSession.active().createDataFrame([(json.dumps(parameters, sort_keys=True),)], "value string").coalesce(1).write.text(f"{path}/parameters")


def thaw(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    import json

    return PipelineModel.load(f"{path}/model"), json.loads(spark.read.text(f"{path}/parameters").first()["value"])
