"""Delay / cancellation scoring as distributed Spark ML jobs.

The per-record scoring of the labs becomes one ``PipelineModel.transform``
over a DataFrame: features are hashed to a fixed width on the executors (no
list of category values reaches the driver), the model is a coefficient vector
of that width, and the output columns (prediction, proba, prediction_delay) are
plain columns.  Both classes weigh the same in training, so the rarer one is
predicted too.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.scalars import event_ts, stable_pick
from contrail.operators.tables import TableRefs

CATEGORICAL = ["uniquecarrier", "origin", "dest"]
NUMERIC = ["week", "hour"]
FEATURES = CATEGORICAL + NUMERIC
WIDTH = 4096  # hashed features
FIT_ROWS = 500_000  # training rows that one task keeps and reads in each iteration


def with_features(flights: DataFrame) -> DataFrame:
    """week (ISO week of the flight date) and hour (from HHMM departure time)."""
    day = F.to_date(event_ts("year", "month", "dayofmonth", F.lit(0)))  # null for an impossible date
    return flights.withColumn("week", F.weekofyear(day)).withColumn("hour", F.expr("deptime div 100").cast("int"))


def feature_text(df: DataFrame) -> Column:
    """The serving input format: ``"carrier,origin,dest,week,hour"``; a null feature is an empty field."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in FEATURES])


def split_features(text: str | Column) -> list[Column]:
    """Typed feature columns of the serving text; missing, empty and unreadable fields are null."""
    parts = F.split(F.col(text) if isinstance(text, str) else text, ",")
    return [F.get(parts, F.lit(i)).try_cast("int").alias(c) for i, c in enumerate(FEATURES)]


def fit(train: DataFrame, label: Column, max_iter: int = 10) -> PipelineModel:
    """All features count as categories.  Class weights are one over the class's share of the rows."""
    labelled = train.withColumn("label", label.cast("double"))
    n, late = labelled.agg(F.count(F.lit(1)), F.sum("label")).first()
    late = late or 0.0
    weight = F.when(F.col("label") == 1, F.lit(n / (2.0 * max(late, 1.0)))).otherwise(F.lit(n / (2.0 * max(n - late, 1.0))))
    stages = [FeatureHasher(inputCols=FEATURES, categoricalCols=FEATURES, numFeatures=WIDTH, outputCol="features"),
              LogisticRegression(featuresCol="features", labelCol="label", weightCol="class_weight", maxIter=max_iter, regParam=0.001)]
    tasks = max(int(train.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // FIT_ROWS + 1)
    return Pipeline(stages=stages).fit(labelled.repartition(tasks, *FEATURES).withColumn("class_weight", weight))


def save(model: PipelineModel, refs: TableRefs, name: str, at: str) -> str:
    """Write the fitted pipeline into a folder of its own and point the named reference at it; returns the folder."""
    spark = SparkSession.getActiveSession()
    path = f"{refs.root}-models/{name}-{uuid.uuid4().hex[:12]}"
    model.write().save(path)
    refs.set(spark, name, path, at, "model")
    return path


def load(spark: SparkSession, refs: TableRefs, name: str) -> PipelineModel:
    """The model that the reference names now; earlier ones stay readable in their folders."""
    return PipelineModel.load(refs.resolve(spark, name))


def score(model: PipelineModel, df: DataFrame, key: str | Column, with_delay: bool = True) -> DataFrame:
    """prediction (0/1), proba (probability of the predicted class, 2 dp) and simulated delay minutes."""
    out = model.transform(df)
    prob = vector_to_array("probability")
    pred = F.col("prediction").cast("int")
    out = out.withColumn("proba", F.round(F.when(pred == 1, prob[1]).otherwise(prob[0]), 2)).withColumn(
        "prediction", pred)
    if with_delay:
        out = out.withColumn("prediction_delay",
                             F.when(pred == 1, stable_pick(key, 50)).otherwise(F.lit(0)).cast("int"))
    return out.withColumn("proba_1", prob[1]).drop("features", "rawPrediction", "probability")
