"""Scalar-function queries: NULL handling, CASE, strings, event time, key=value text, casts, arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail.functions.scalars import event_text, event_ts, kv_fixed_width, kv_number, parse_event_text
from contrail.operators.aggregates import nvl0
from contrail.plans.registry import register
from contrail.sources.tables import flights, table, with_views


@register("scalar_null_case", with_views("""
SELECT coalesce(depdelay, -999) AS dep_or_default,
       CASE WHEN coalesce(depdelay, 0) > 0 THEN 'late' END AS late_flag,
       CASE cancellationcode WHEN 'F' THEN 'carrier' WHEN 'O' THEN 'weather' END AS cause,
       count(*) AS n_flights
FROM flights GROUP BY 1, 2, 3""", "flights"))
def scalar_null_case(spark, d):
    f = flights(spark, d)
    return f.groupBy(
        F.coalesce("depdelay", F.lit(-999)).alias("dep_or_default"),
        F.when(nvl0("depdelay") > 0, F.lit("late")).alias("late_flag"),
        F.when(F.col("cancellationcode") == "F", F.lit("carrier"))
        .when(F.col("cancellationcode") == "O", F.lit("weather")).alias("cause"),
    ).agg(F.count(F.lit(1)).alias("n_flights"))


@register("scalar_strings", """
SELECT c_custkey, concat('Update - ', upper(c_name)) AS new_name, CAST(length(c_name) AS INTEGER) AS name_len,
       regexp_replace(c_name, '#0*', '-', 'g') AS short_name, c_mktsegment || '/' || c_name AS tagged
FROM customer""")
def scalar_strings(spark, d):
    c = table(spark, d, "customer")
    return c.select(
        "c_custkey",
        F.concat(F.lit("Update - "), F.upper("c_name")).alias("new_name"),
        F.length("c_name").alias("name_len"),
        F.regexp_replace("c_name", "#0*", "-").alias("short_name"),
        F.concat("c_mktsegment", F.lit("/"), "c_name").alias("tagged"),
    )


@register("scalar_event_time", with_views("""
, e AS (SELECT DISTINCT year, month, dayofmonth, deptime,
          concat(year, '-', month, '-', dayofmonth, ' ', substr(lpad(CAST(deptime AS VARCHAR), 4, '0'), 1, 2), ':',
                 substr(lpad(CAST(deptime AS VARCHAR), 4, '0'), 3, 2), ':00') AS event_text,
          make_timestamp(year, month, dayofmonth, deptime // 100, deptime % 100, 0) AS ts FROM flights)
SELECT year, month, dayofmonth, deptime, event_text, CAST(epoch(ts) AS BIGINT) AS event_epoch,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_str, CAST(epoch(ts) AS BIGINT) AS built_epoch
FROM e""", "flights"))
def scalar_event_time(spark, d):
    f = flights(spark, d).select("year", "month", "dayofmonth", "deptime").distinct()
    text = event_text("year", "month", "dayofmonth", "deptime")
    out = f.withColumn("event_text", text).withColumn("event_epoch", parse_event_text("event_text"))
    return out.select(
        "year", "month", "dayofmonth", "deptime", "event_text", "event_epoch",
        F.from_unixtime("event_epoch").alias("event_str"),
        F.unix_timestamp(event_ts("year", "month", "dayofmonth", "deptime")).alias("built_epoch"),
    )


def landing_text(events):
    """Key=value text as landed: plain numbers, one in exponent notation, one missing in every seventh row."""
    gust = F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit(", speed="), (events["value"] / 1e7).cast("string")))
    return F.concat(F.lit("{temp="), events["value"].cast("string"), F.lit(", pressure=1013.2, humidity="),
                    (events["user_id"] % 101).cast("string"), gust, F.lit(", all="), (events["event_id"] % 100).cast("string"),
                    F.lit("} {prediction="), (events["event_id"] % 2).cast("string"), F.lit(", proba=0.75, prediction_delay="),
                    (events["event_id"] % 50).cast("string"), F.lit("}"))


@register("scalar_kv_parse", """
SELECT event_id, value AS temp, CAST(1013.2 AS DOUBLE) AS pressure, CAST(user_id % 101 AS DOUBLE) AS humidity,
  CASE WHEN event_id % 7 <> 0 THEN value / 1e7 END * 1e7 AS wind_speed_e7, CAST(event_id % 100 AS DOUBLE) AS clouds,
  CAST(event_id % 2 AS DOUBLE) AS prediction, CAST(0.75 AS DOUBLE) AS proba, CAST(event_id % 50 AS DOUBLE) AS prediction_delay,
  CASE WHEN event_id % 7 = 0 OR user_id % 101 >= 10 THEN substr(CAST(user_id % 101 AS VARCHAR), 1, 2) || CASE WHEN user_id % 101 < 10 THEN ',' ELSE '' END
       ELSE CAST(user_id % 101 AS VARCHAR) || ',' END AS humidity_fixed_width
FROM events""")
def scalar_kv_parse(spark, d):
    e = table(spark, d, "events")
    w = e.select("event_id", landing_text(e).alias("t"))
    return w.select(
        "event_id",
        kv_number("t", "temp").alias("temp"),
        kv_number("t", "pressure").alias("pressure"),
        kv_number("t", "humidity").alias("humidity"),
        (kv_number("t", "speed") * 1e7).alias("wind_speed_e7"),
        kv_number("t", "all").alias("clouds"),
        kv_number("t", "prediction").alias("prediction"),
        kv_number("t", "proba").alias("proba"),
        kv_number("t", "prediction_delay").alias("prediction_delay"),
        kv_fixed_width("t", "humidity", 2, "}").alias("humidity_fixed_width"),
    )


@register("scalar_casts", """
SELECT event_id, CAST(trunc(value) AS INTEGER) AS value_int, CAST(value AS FLOAT) AS value_float,
       CAST(value AS DECIMAL(10, 0)) AS value_dec0, CAST(value AS DECIMAL(10, 2)) AS value_dec2,
       CAST(event_id AS VARCHAR) AS id_text, CAST(ts AS DATE) AS event_date,
       TRY_CAST(substr(props, 7, 2) AS INTEGER) AS k_value, TRY_CAST(event_type AS INTEGER) AS type_as_int
FROM events""")
def scalar_casts(spark, d):
    e = table(spark, d, "events")
    return e.select(
        "event_id",
        F.col("value").cast("int").alias("value_int"),
        F.col("value").cast("float").alias("value_float"),
        F.col("value").cast("decimal(10,0)").alias("value_dec0"),
        F.col("value").cast("decimal(10,2)").alias("value_dec2"),
        F.col("event_id").cast("string").alias("id_text"),
        F.col("ts").cast("date").alias("event_date"),
        F.substring("props", 7, 2).try_cast("int").alias("k_value"),
        F.col("event_type").try_cast("int").alias("type_as_int"),
    )


@register("scalar_arith", with_views("""
SELECT uniquecarrier, CAST(sum(arrdelay - depdelay) AS BIGINT) AS sum_delay_gain,
       CAST(sum(distance * 2) AS BIGINT) AS twice_distance, round(avg(distance / 60.0), 6) AS avg_hours,
       CAST(sum(CASE WHEN arrdelay > depdelay THEN 1 ELSE 0 END) AS BIGINT) AS n_gained,
       CAST(sum(airtime + taxiin + taxiout - actualelapsedtime) AS BIGINT) AS residual
FROM flights GROUP BY uniquecarrier""", "flights"))
def scalar_arith(spark, d):
    f = flights(spark, d)
    return f.groupBy("uniquecarrier").agg(
        F.sum(F.col("arrdelay") - F.col("depdelay")).alias("sum_delay_gain"),
        F.sum(F.col("distance") * 2).alias("twice_distance"),
        F.round(F.avg(F.col("distance") / 60.0), 6).alias("avg_hours"),
        F.sum(F.when(F.col("arrdelay") > F.col("depdelay"), 1).otherwise(0)).alias("n_gained"),
        F.sum(F.col("airtime") + F.col("taxiin") + F.col("taxiout") - F.col("actualelapsedtime")).alias("residual"),
    )
