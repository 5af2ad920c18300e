"""Scoring queries: delay and cancellation models trained and applied on the whole fact."""

from __future__ import annotations

import hashlib

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.operators import scoring as sc
from contrail.operators.tables import TableRefs
from contrail.plans.registry import register
from contrail.session import path_exists, scratch_path
from contrail.sources.tables import fact_fingerprint, flights, with_views

_OUT = ["year", "month", "dayofmonth", "uniquecarrier", "flightnum", "tailnum", "origin", "dest", "week", "hour"]


FITTED_AT = "2024-05-01 00:00:00"
_STORES: dict[tuple[str, str, str], TableRefs] = {}


def model_store(spark: SparkSession, d: str, kind: str) -> TableRefs:
    """Where the fitted ``delay`` or ``cancelled`` model of a data set lies; it is fitted once, every query loads it.

    With ``contrail.model.dir`` set to a shared folder, later applications load what an earlier one fitted.
    """
    base = spark.conf.get("contrail.model.dir", "")
    key = (spark.sparkContext.applicationId, d.rstrip("/"), kind)
    if key not in _STORES:
        name = hashlib.sha256(f"{fact_fingerprint(spark, d)} {sc.FEATURES} {sc.WIDTH}".encode()).hexdigest()[:16]
        refs = TableRefs(f"{base.rstrip('/')}/{kind}-{name}" if base else scratch_path(spark, f"model-{kind}"))
        if not path_exists(spark, refs.root):
            f = sc.with_features(flights(spark, d))
            label = late() if kind == "delay" else F.col("cancelled") == 1
            sc.save(sc.fit(f.select(*sc.FEATURES, "depdelay", "cancelled"), label), refs, kind, FITTED_AT)
        _STORES[key] = refs
    return _STORES[key]


def stored_model(spark: SparkSession, d: str, kind: str) -> PipelineModel:
    return sc.load(spark, model_store(spark, d, kind), kind)


def late() -> Column:
    return F.coalesce(F.col("depdelay"), F.lit(0)) > 15


def scored_delay(spark: SparkSession, d: str) -> DataFrame:
    """Every flight with prediction, proba and simulated delay minutes (and ``late``, the label)."""
    f = sc.with_features(flights(spark, d)).select(*_OUT, "depdelay", "distance")
    model = stored_model(spark, d, "delay")
    return sc.score(model, f, F.col("flightnum") * 100003 + F.col("tailnum")).withColumn("late", late())


def scored_cancelled(spark: SparkSession, d: str) -> DataFrame:
    f = sc.with_features(flights(spark, d)).select(*_OUT, "cancelled")
    model = stored_model(spark, d, "cancelled")
    return sc.score(model, f, F.col("flightnum"), with_delay=False).withColumn("late", F.col("cancelled") == 1)


def run_summary(scored: DataFrame, delay_rule: Column) -> DataFrame:
    """One row over a whole scoring run: volume, domain and rule violations, and whether the model tells the classes apart."""
    p = F.col("prediction")
    outside = ~p.isin(0, 1) | (F.col("proba") < 0.5) | (F.col("proba") > 1)
    true_rate = F.avg(F.when(F.col("late"), p.cast("double")))
    false_rate = F.avg(F.when(~F.col("late"), p.cast("double")))
    return scored.agg(
        F.count(F.lit(1)).alias("n_scored"), F.count(F.when(outside, 1)).alias("domain_violations"),
        (F.min(p) < F.max(p)).alias("both_classes"), F.count(F.when(~delay_rule, 1)).alias("delay_rule_violations"),
        (F.avg(F.when(F.col("late"), F.col("proba_1"))) > F.avg(F.when(~F.col("late"), F.col("proba_1")))).alias("ranks_late_higher"),
        ((true_rate + 1 - false_rate) / 2 > 0.5).alias("beats_base_rate"))


# A trained model has no SQL form; what DuckDB can state is what every run must satisfy.
_SUMMARY_SQL = with_views("""
SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS domain_violations, true AS both_classes,
       CAST(0 AS BIGINT) AS delay_rule_violations, true AS ranks_late_higher, true AS beats_base_rate FROM flights""", "flights")


@register("score_delay", _SUMMARY_SQL)
def score_delay(spark, d):
    minutes = F.col("prediction_delay")
    rule = F.when(F.col("prediction") == 1, minutes.between(1, 50)).otherwise(minutes == 0)
    return run_summary(scored_delay(spark, d), rule)


@register("score_cancelled", _SUMMARY_SQL)
def score_cancelled(spark, d):
    return run_summary(scored_cancelled(spark, d), F.lit(True))


@register("score_feature_split", with_views("""
SELECT uniquecarrier, origin, dest, CAST(weekofyear(make_date(year, month, dayofmonth)) AS INTEGER) AS week,
       CAST(deptime // 100 AS INTEGER) AS hour FROM flights""", "flights"))
def score_feature_split(spark, d):
    """Serving-format text ``"carrier,origin,dest,week,hour"`` split back into typed feature columns."""
    f = sc.with_features(flights(spark, d))
    return f.select(sc.feature_text(f).alias("t")).select(*sc.split_features("t"))


@register("score_metrics", with_views("""
SELECT p.prediction, true AS proba_in_range, true AS delay_in_range, (SELECT count(*) FROM flights) AS n_scored_in_all
FROM (VALUES (0), (1)) AS p(prediction)""", "flights"))
def score_metrics(spark, d):
    """Monitoring metrics of a scoring run, per predicted class, with their ranges checked."""
    per = metrics(scored_delay(spark, d))
    n, minutes = F.col("n_scored"), F.col("predicted_delay_min")
    return per.select("prediction", F.col("avg_proba").between(0.5, 1.0).alias("proba_in_range"),
                      F.when(F.col("prediction") == 1, minutes.between(n, 50 * n)).otherwise(minutes == 0).alias("delay_in_range"),
                      F.sum("n_scored").over(Window.partitionBy()).alias("n_scored_in_all"))  # two rows


def metrics(scored: DataFrame) -> DataFrame:
    """Volume, mean probability and predicted minutes per predicted class."""
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n_scored"), F.avg("proba").alias("avg_proba"),
                                            F.sum("prediction_delay").alias("predicted_delay_min"))
