"""Streaming queries: typed ingest, micro-batches with offsets, late rows, windows, enrichment, data mart.

Every stream runs with ``trigger(availableNow=True)`` over what has landed,
into a fresh checkpoint folder under the shared checkpoint location, and the
query then reads the resulting table back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators import scoring as sc
from contrail.operators.joins import dim_join
from contrail.plans.registry import register
from contrail.plans.scoring import stored_model
from contrail.session import scratch_path
from contrail.sources.tables import airports, table
from contrail.streaming import pipeline as pl

SPLIT_TS = "2024-01-16 00:00:00"
LATE_UNTIL = "2024-01-17 00:00:00"
RUN_TS = "2024-05-22 12:45:50"


def _late_rule():
    """Second-drop error events of its first day arrive two days late."""
    return (F.col("event_type") == "error") & (F.col("ts").cast("timestamp") < F.lit(LATE_UNTIL).cast("timestamp"))


def _pipeline(spark: SparkSession, d: str, allowed_lateness_s: int | None = None, files_per_drop: int | None = None,
              files_per_trigger: int | None = None) -> pl.PipelinePaths:
    root = scratch_path(spark, "flights-stream")
    paths = pl.PipelinePaths(f"{root}/landing", f"{root}/final", f"{root}/offsets", f"{root}/_checkpoint")
    pl.write_landing_drops(spark, table(spark, d, "events"), paths.landing, SPLIT_TS, _late_rule(),
                           files_per_drop=files_per_drop)
    pl.run_micro_batches(spark, paths, files_per_trigger, allowed_lateness_s=allowed_lateness_s, run_ts=RUN_TS)
    return paths


_EP = "CAST(floor(epoch_us({t}) / 1000000) AS BIGINT)"
_LANDED_SQL = f"""landed AS (
  SELECT event_id, CASE WHEN ts >= TIMESTAMP '{SPLIT_TS}' THEN 1 ELSE 0 END AS drop_no,
    CASE WHEN ts >= TIMESTAMP '{SPLIT_TS}' AND event_type = 'error' AND ts < TIMESTAMP '{LATE_UNTIL}'
         THEN ts - INTERVAL 2 DAYS ELSE ts END AS ts FROM events),
ep AS (SELECT event_id, drop_no, {_EP.format(t="ts")} AS e FROM landed),
b0 AS (SELECT 0 AS batch_id, min(e) AS from_ts, max(e) AS to_ts, count(*) AS row_count FROM ep WHERE drop_no = 0),
b1 AS (SELECT 1 AS batch_id, min(e) AS from_ts, max(e) AS to_ts, count(*) AS row_count FROM ep
       WHERE drop_no = 1 AND e > (SELECT to_ts FROM b0)),
offsets AS (SELECT * FROM b0 UNION ALL SELECT * FROM b1)"""


@register("stream_micro_batch_offsets", f"""WITH {_LANDED_SQL}
SELECT CAST(batch_id AS BIGINT) AS batch_id, from_ts, to_ts, row_count FROM offsets WHERE row_count > 0""")
def stream_micro_batch_offsets(spark, d):
    """Two landed drops; the offset log gives one row per drop that kept rows."""
    paths = _pipeline(spark, d)
    return pl.read_offsets(spark, paths).select("batch_id", "from_ts", "to_ts", "row_count")


@register("stream_reconcile_counts", f"""WITH {_LANDED_SQL}
SELECT CAST(batch_id AS BIGINT) AS batch_id, strftime(make_timestamp(from_ts * 1000000), '%Y-%m-%d %H:%M:%S')
         AS ingest_from, strftime(make_timestamp(to_ts * 1000000), '%Y-%m-%d %H:%M:%S') AS ingest_to,
       row_count AS total_process, row_count AS sink_rows, true AS reconciled
FROM offsets WHERE row_count > 0""")
def stream_reconcile_counts(spark, d):
    """Offset report with readable times, reconciled against the rows found in the sink per batch."""
    paths = _pipeline(spark, d)
    offsets = pl.read_offsets(spark, paths)
    sink = pl.read_sink(spark, paths).groupBy("batch_id").agg(F.count(F.lit(1)).alias("sink_rows"))
    rep = offsets.join(sink, "batch_id", "left").select(
        "batch_id", F.from_unixtime("from_ts").alias("ingest_from"), F.from_unixtime("to_ts").alias("ingest_to"),
        F.col("row_count").alias("total_process"), F.coalesce("sink_rows", F.lit(0)).alias("sink_rows"))
    return rep.withColumn("reconciled", F.col("total_process") == F.col("sink_rows"))


@register("stream_late_rows", f"""WITH {_LANDED_SQL}
SELECT 'strict' AS policy, CAST((SELECT sum(row_count) FROM offsets) AS BIGINT) AS kept_rows,
       CAST(count(*) - (SELECT sum(row_count) FROM offsets) AS BIGINT) AS dropped_rows FROM events
UNION ALL SELECT 'allowed_lateness_3d', count(*), 0 FROM events""")
def stream_late_rows(spark, d):
    """Strict high-water mark loses late rows; a three-day allowed lateness keeps them without duplicates."""
    landed = table(spark, d, "events").agg(F.count(F.lit(1))).scalar()

    def summary(paths: pl.PipelinePaths, policy: str) -> DataFrame:
        kept = pl.read_sink(spark, paths).agg(F.count(F.lit(1)).alias("kept_rows"))
        return kept.select(F.lit(policy).alias("policy"), F.col("kept_rows").cast("long"),
                           (landed - F.col("kept_rows")).alias("dropped_rows"))

    strict = summary(_pipeline(spark, d), "strict")
    lenient = summary(_pipeline(spark, d, allowed_lateness_s=3 * 86400), "allowed_lateness_3d")
    return strict.unionByName(lenient)


_LON = "CAST({k} % 25 * 7.5 - 90 AS DOUBLE)"
_LAT = "CAST({k} % 25 * 1.25 + 20 AS DOUBLE)"
_PROBA = "CAST(0.5 + (event_id * 7919) % 50 / 100.0 AS DOUBLE)"
_TYPED_SQL = f"""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts, user_id, event_type, value,
  CAST(user_id % 25 AS INTEGER) AS dest, {_LON.format(k="event_id")} AS origin_lon, {_LAT.format(k="event_id")} AS origin_lat,
  {_LON.format(k="user_id")} AS dest_lon, {_LAT.format(k="user_id")} AS dest_lat,
  value AS temp, CAST(1013.2 AS DOUBLE) AS pressure, CAST(user_id % 101 AS DOUBLE) AS humidity,
  CAST(NULL AS DOUBLE) AS wind_speed, CAST(event_id % 100 AS DOUBLE) AS clouds, CASE event_type WHEN 'error' THEN 1 ELSE 0 END AS prediction,
  {_PROBA} AS proba, CAST(CASE event_type WHEN 'error' THEN (event_id * 7919) % 50 + 1 ELSE 0 END AS INTEGER) AS prediction_delay
FROM events"""


def _ts_text(df: DataFrame) -> DataFrame:
    return df.withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@register("stream_ingest_typed", _TYPED_SQL)
def stream_ingest_typed(spark, d):
    """Stream the events file as all-string landing rows through the typed view into a table."""
    typed = pl.typed_events(pl.to_landing(pl.stream_events(spark, d)))
    path = scratch_path(spark, "flights-typed")
    pl.run_to_table(typed, path, scratch_path(spark, "ckpt-typed"))
    return _ts_text(spark.read.parquet(path))


@register("stream_tumbling_15m", """
SELECT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
       count(*) AS count FROM events GROUP BY time_bucket(INTERVAL 15 MINUTE, ts)""")
def stream_tumbling_15m(spark, d):
    """Fifteen-minute tumbling counts from a watermarked streaming aggregate (update mode)."""
    typed = pl.typed_events(pl.to_landing(pl.stream_events(spark, d)))
    counts = typed.withWatermark("event_ts", "2 hours").groupBy(F.window("event_ts", "15 minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("count"))
    result = pl.run_updating_aggregate(counts, ["w"], scratch_path(spark, "tumbling-updates"),
                                       scratch_path(spark, "ckpt-tumbling"))
    return result.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                         F.date_format("w.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"), "count")


_LATE_WEATHER_FROM = "2024-01-15 00:00:00"


@register("stream_weather_join", """
WITH w AS (SELECT CAST(user_id % 25 AS INTEGER) AS dest, date_trunc('hour', ts) AS observed, round(avg(value), 6) AS mean_temp, max(value) AS max_temp
           FROM events GROUP BY 1, 2)
SELECT e.event_id, w.dest, strftime(w.observed, '%Y-%m-%d %H:%M:%S') AS observed, w.mean_temp, w.max_temp
FROM events e JOIN w ON w.dest = CAST(e.user_id % 25 AS INTEGER) AND e.ts >= w.observed AND e.ts < w.observed + INTERVAL 1 HOUR""")
def stream_weather_join(spark, d):
    """Two streams joined by destination and hour; a fifth of the airports send the last day before the split late."""
    events, root = table(spark, d, "events"), scratch_path(spark, "weather-join")
    late = (F.col("dest") % 5 == 0) & (F.col("observed") >= F.lit(_LATE_WEATHER_FROM).cast("timestamp"))
    for drop in (0, 1):  # each run takes what has landed since the one before and keeps its state in the checkpoint
        pl.write_landing_drops(spark, events, f"{root}/events", SPLIT_TS, drops=(drop,))
        pl.write_weather_drops(events, f"{root}/weather", SPLIT_TS, late, drops=(drop,))
        typed = pl.typed_events(pl.landing_stream(spark, f"{root}/events")).select("event_id", "dest", "event_ts")
        joined = pl.with_weather(typed, pl.weather_stream(spark, f"{root}/weather").drop("drop"))
        pl.run_to_table(joined.select("event_id", "dest", "observed", "mean_temp", "max_temp"), f"{root}/out", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/out").withColumn("observed", F.date_format("observed", "yyyy-MM-dd HH:mm:ss"))


@register("stream_enrich_score", """
WITH w AS (SELECT CAST(user_id % 25 AS INTEGER) AS dest, date_trunc('hour', ts) AS h, round(avg(value), 6) AS mean_temp, max(value) AS max_temp
           FROM events GROUP BY 1, 2)
SELECT e.event_id, w.dest, n.n_name AS dest_city, e.value AS temp, w.mean_temp, w.max_temp, true AS model_in_domain, true AS delay_follows_prediction
FROM events e JOIN nation n ON CAST(e.user_id % 25 AS INTEGER) = n.n_nationkey
JOIN w ON w.dest = CAST(e.user_id % 25 AS INTEGER) AND w.h = date_trunc('hour', e.ts)""")
def stream_enrich_score(spark, d):
    """Stream-static joins (destination city, hourly weather), then the stored delay model."""
    events = table(spark, d, "events")
    typed = pl.typed_events(pl.to_landing(pl.stream_events(spark, d))).drop("prediction", "proba", "prediction_delay")
    ap = airports(spark, d).select(F.col("iata").alias("dest"), F.col("city").alias("dest_city"))
    wide = dim_join(typed.withColumn("hour_ts", F.date_trunc("hour", "event_ts")), ap, "dest")
    wide = dim_join(wide, pl.weather_frame(events), ["dest", "hour_ts"])
    model = stored_model(spark, d, "delay")  # the one that batch scoring loads
    features = wide.withColumns({"uniquecarrier": F.col("user_id").cast("int"), "origin": (F.col("event_id") % pl.N_AIRPORTS).cast("int"),
                                 "week": F.weekofyear("event_ts"), "hour": F.hour("event_ts")})
    out = sc.score(model, features, "event_id")
    path = scratch_path(spark, "flights-enriched")
    pl.run_to_table(out.select("event_id", "dest", "dest_city", "temp", "mean_temp", "max_temp", "prediction", "proba", "prediction_delay"),
                    path, scratch_path(spark, "ckpt-enriched"))
    minutes = F.col("prediction_delay")
    return spark.read.parquet(path).select(
        "event_id", "dest", "dest_city", "temp", "mean_temp", "max_temp",
        (F.col("prediction").isin(0, 1) & F.col("proba").between(0.5, 1.0)).alias("model_in_domain"),
        F.when(F.col("prediction") == 1, minutes.between(1, 50)).otherwise(minutes == 0).alias("delay_follows_prediction"))


def hourly_mart(final: DataFrame, ap: DataFrame) -> DataFrame:
    """hour × destination airport × city: weather maxima and predicted delays."""
    j = dim_join(final, ap.select(F.col("iata").alias("dest"), F.col("city").alias("destination_city")), "dest")
    return j.groupBy(F.date_format("event_ts", "yyyy/MM/dd HH:00:00").alias("daytime"),
                     F.col("dest").alias("destination_airport"), "destination_city").agg(
        F.max("temp").alias("dest_temp"), F.max("wind_speed").alias("dest_wind_speed"),
        F.max("pressure").alias("dest_pressure"), F.sum("prediction").alias("predicted_delayed"),
        F.sum("prediction_delay").alias("predicted_delay_min"))


@register("mart_hourly_airport", """
SELECT strftime(ts, '%Y/%m/%d %H:00:00') AS daytime, CAST(user_id % 25 AS INTEGER) AS destination_airport,
  n.n_name AS destination_city, max(value) AS dest_temp, CAST(NULL AS DOUBLE) AS dest_wind_speed,
  max(CAST(1013.2 AS DOUBLE)) AS dest_pressure, CAST(sum(CASE event_type WHEN 'error' THEN 1 ELSE 0 END) AS BIGINT) AS predicted_delayed,
  CAST(sum(CASE event_type WHEN 'error' THEN (event_id * 7919) % 50 + 1 ELSE 0 END) AS BIGINT) AS predicted_delay_min
FROM events e JOIN nation n ON CAST(e.user_id % 25 AS INTEGER) = n.n_nationkey
GROUP BY 1, 2, 3""")
def mart_hourly_airport(spark, d):
    """INSERT OVERWRITE of the hourly mart from the typed sink table, then read back."""
    final = pl.typed_events(pl.to_landing(table(spark, d, "events")))
    path = scratch_path(spark, "airport-delayed-flights")
    hourly_mart(final, airports(spark, d)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
