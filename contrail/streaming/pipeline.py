"""Structured Streaming ingest: landing text → typed events → sink + offset log.

* :func:`typed_events` is the typed view over the all-string landing rows;
  it is a plain DataFrame function, so the same code serves batch and stream.
* The landing folder holds one folder per drop (``drop=<n>``), with any number of
  files.  :func:`run_micro_batches` drives a ``foreachBatch`` query; a drop may be
  spread over several micro-batches and a micro-batch may hold several drops.
  A row is kept when it is newer than the high-water mark of all *earlier
  drops*, so how a drop is cut into files and batches changes nothing.
* Repeated events are removed by the stream's keyed state behind a watermark.
* Each micro-batch overwrites its own partition of the sink, of the offset log
  and of the marks, and reads only the marks of the batch before, so a replayed
  batch (after a lost executor or driver restart) produces the same state; the
  checkpoint folder gives exactly-once batch ids.  Rows whose event time does
  not parse and rows behind the mark are counted in the offset log.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.scalars import kv_number, stable_pick

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props",
                 "origin_lon", "origin_lat", "dest_lon", "dest_lat", "prediction", "weather_json"]
LANDING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in EVENT_COLUMNS])
DROP_SCHEMA = T.StructType([*LANDING_SCHEMA.fields, T.StructField("drop", T.IntegerType())])
N_AIRPORTS = 25


def weather_text(value: Column, user_id: Column, event_id: Column) -> Column:
    """Upstream weather text: ``{temp=<value>, pressure=1013.2, humidity=<user_id % 101>, all=<event_id % 100>}``."""
    return F.concat(F.lit("{temp="), value.cast("string"), F.lit(", pressure=1013.2, humidity="), (user_id % 101).cast("string"),
                    F.lit(", all="), (event_id % 100).cast("string"), F.lit("}"))


def prediction_text(event_type: Column, event_id: Column) -> Column:
    """Upstream model output as text: ``{prediction=<0|1>, proba=<p>, prediction_delay=<minutes>}``."""
    late = event_type == "error"
    return F.concat(F.lit("{prediction="), F.when(late, F.lit("1")).otherwise(F.lit("0")),
                    F.lit(", proba="), (0.5 + F.pmod(event_id * 7919, F.lit(50)) / 100).cast("decimal(4,2)").cast("string"),
                    F.lit(", prediction_delay="), F.when(late, stable_pick(event_id, 50)).otherwise(F.lit(0)).cast("string"), F.lit("}"))


def to_landing(events: DataFrame) -> DataFrame:
    """Events as the landing table holds them: every column a string, coordinates, weather and model output attached."""
    dest, origin = F.col("user_id") % N_AIRPORTS, F.col("event_id") % N_AIRPORTS
    place = {"origin_lon": origin * 7.5 - 90, "origin_lat": origin * 1.25 + 20, "dest_lon": dest * 7.5 - 90, "dest_lat": dest * 1.25 + 20}
    wide = events.select("*", *[v.alias(k) for k, v in place.items()],
                         prediction_text(F.col("event_type"), F.col("event_id")).alias("prediction"),
                         weather_text(F.col("value"), F.col("user_id"), F.col("event_id")).alias("weather_json"))
    return wide.select(*[F.col(c).cast("string").alias(c) for c in EVENT_COLUMNS])


def typed_events(raw: DataFrame) -> DataFrame:
    """Typed view over landing rows (batch or stream); bad values become NULL, never errors."""
    number = lambda c: F.col(c).try_cast("double").alias(c)
    drop = [F.col("drop")] if "drop" in raw.columns else []
    return raw.select(
        F.col("event_id").try_cast("long").alias("event_id"),
        F.col("ts").try_cast("timestamp").alias("event_ts"),
        F.col("user_id").try_cast("long").alias("user_id"),
        F.col("event_type"),
        number("value"),
        (F.col("user_id").try_cast("long") % N_AIRPORTS).cast("int").alias("dest"),
        number("origin_lon"), number("origin_lat"), number("dest_lon"), number("dest_lat"),
        kv_number("weather_json", "temp").alias("temp"),
        kv_number("weather_json", "pressure").alias("pressure"),
        kv_number("weather_json", "humidity").alias("humidity"),
        kv_number("weather_json", "speed").alias("wind_speed"),
        kv_number("weather_json", "all").alias("clouds"),
        kv_number("prediction", "prediction").try_cast("int").alias("prediction"),
        kv_number("prediction", "proba").alias("proba"),
        kv_number("prediction", "prediction_delay").try_cast("int").alias("prediction_delay"),
        *drop,
    )


def write_landing_drops(spark: SparkSession, events: DataFrame, root: str, split_ts: str,
                        late: Column | None = None, late_shift: str = "INTERVAL 2 DAYS",
                        files_per_drop: int | None = None, drops: tuple[int, ...] = (0, 1)) -> None:
    """Land ``events`` in two drops (before / from ``split_ts``), oldest first; ``drops`` says which of them now.

    Rows of the second drop matching ``late`` get their time moved back by
    ``late_shift``: they arrive after newer rows were already ingested.  A drop
    has one file per input partition unless ``files_per_drop`` says otherwise.
    """
    land = to_landing(events)
    ts = F.col("ts").cast("timestamp")
    first = land.where(ts < F.lit(split_ts).cast("timestamp"))
    # Rows without a readable time land too; ingest counts them.
    second = land.where((ts >= F.lit(split_ts).cast("timestamp")) | ts.isNull())
    if late is not None:
        shifted = (ts - F.expr(late_shift)).cast("timestamp_ntz").cast("string")
        second = second.withColumn("ts", F.when(late, shifted).otherwise(F.col("ts")))
    for i, drop in enumerate((first, second)):
        if i not in drops:
            continue
        cut = drop if files_per_drop is None else drop.repartition(files_per_drop)
        cut.write.mode("overwrite").parquet(f"{root}/drop={i}")


@dataclass
class PipelinePaths:
    landing: str
    sink: str
    offsets: str
    checkpoint: str

    @property
    def marks(self) -> str:
        return f"{self.offsets}-marks"


OFFSET_SCHEMA = "run_ts timestamp, drop int, from_ts long, to_ts long, max_ts long, row_count long, late_rows long, rejected_rows long, micro_batch long"


def read_offsets(spark: SparkSession, paths: PipelinePaths) -> DataFrame:
    """One row per drop (``batch_id``) that kept rows: time range, rows kept, late and rejected rows."""
    log = spark.read.schema(OFFSET_SCHEMA).parquet(paths.offsets)
    per = log.groupBy(F.col("drop").cast("long").alias("batch_id")).agg(
        F.min("run_ts").alias("run_ts"), F.min("from_ts").alias("from_ts"), F.max("to_ts").alias("to_ts"),
        F.sum("row_count").alias("row_count"), F.sum("late_rows").alias("late_rows"), F.sum("rejected_rows").alias("rejected_rows"))
    return per.where(F.col("row_count") > 0)


def read_rejections(spark: SparkSession, paths: PipelinePaths) -> DataFrame:
    """(batch_id, late_rows, rejected_rows) of every drop, also of those that kept nothing."""
    log = spark.read.schema(OFFSET_SCHEMA).parquet(paths.offsets)
    return log.groupBy(F.col("drop").cast("long").alias("batch_id")).agg(
        F.sum("late_rows").alias("late_rows"), F.sum("rejected_rows").alias("rejected_rows"))


def read_sink(spark: SparkSession, paths: PipelinePaths) -> DataFrame:
    return spark.read.parquet(paths.sink).withColumn("micro_batch", F.col("micro_batch").cast("long"))


_MARKS = "drop int, newest long, micro_batch long"
KEPT_DROPS = 256


def _known_marks(spark: SparkSession, paths: PipelinePaths, micro_batch: int) -> dict[int, int]:
    """Newest event time by drop as the micro-batch before left it: one small file, never the offset log."""
    if micro_batch == 0:
        return {}
    return {r["drop"]: r["newest"] for r in spark.read.schema(_MARKS).parquet(f"{paths.marks}/micro_batch={micro_batch - 1}").select("drop", "newest").collect()}


def _keep_marks(spark: SparkSession, paths: PipelinePaths, micro_batch: int, newest: dict[int, int]) -> None:
    """Write the marks for the next micro-batch.

    The last ``KEPT_DROPS`` drops have a row each, all older ones share a row, so
    the state does not grow with the stream.  A file that lands for a drop older than that is held to the shared mark.
    """
    drops = sorted(newest)
    old, last = drops[:-KEPT_DROPS], drops[-KEPT_DROPS:]
    rows = [(old[-1], max(newest[d] for d in old))] if old else []
    spark.createDataFrame(rows + [(d, newest[d]) for d in last], "drop int, newest long").coalesce(1).write.mode("overwrite").parquet(
        f"{paths.marks}/micro_batch={micro_batch}")


def make_batch_writer(paths: PipelinePaths, allowed_lateness_s: int | None = None, run_ts: str | None = None):
    """The ``foreachBatch`` body (high-water filter per drop, sweep to the sink, offset rows).

    Neither the sink nor the offset log is read: marks come from the small state
    of the micro-batch before, duplicates have been removed by the stream's own state.
    """

    def process(batch: DataFrame, micro_batch: int) -> None:
        spark = batch.sparkSession
        typed = batch.withColumn("event_epoch", F.unix_timestamp("event_ts")).persist()
        try:
            write(spark, typed, micro_batch)
        finally:
            typed.unpersist()

    def write(spark: SparkSession, typed: DataFrame, micro_batch: int) -> None:
        # One row per drop in this batch.
        seen = typed.groupBy("drop").agg(F.max("event_epoch").alias("max_ts"), F.count(F.lit(1)).alias("n"),
                                         F.count(F.when(F.col("event_epoch").isNull(), 1)).alias("rejected")).collect()
        newest = _known_marks(spark, paths, micro_batch)
        for r in seen:
            newest[r["drop"]] = max(newest.get(r["drop"], 0), r["max_ts"] or 0)
        if seen:
            # High-water mark of a drop: the newest event time of all earlier ones (0 when none).
            marks = {r["drop"]: max([m for d, m in newest.items() if d < r["drop"]], default=0) for r in seen}
            floor = F.element_at(F.create_map(*[F.lit(x) for d, m in marks.items() for x in (d, m)]), F.col("drop")) - F.lit(allowed_lateness_s or 0)
            new = typed.where(F.col("event_epoch") > floor)      # without lateness the strict rule: late rows are lost
            kept = {r["drop"]: r for r in new.groupBy("drop").agg(F.min("event_epoch").alias("lo"), F.max("event_epoch").alias("hi"),
                                                                  F.count(F.lit(1)).alias("n")).collect()}
            (new.withColumn("batch_id", F.col("drop").cast("long")).withColumn("micro_batch", F.lit(micro_batch).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("micro_batch").parquet(paths.sink))
            rows = []
            for r in seen:
                k = kept.get(r["drop"])
                n = k["n"] if k else 0
                rows.append((r["drop"], k["lo"] if k else None, k["hi"] if k else None, r["max_ts"], n, r["n"] - n - r["rejected"], r["rejected"]))
            log = spark.createDataFrame(rows, "drop int, from_ts long, to_ts long, max_ts long, row_count long, late_rows long, rejected_rows long")
            log = log.withColumn("run_ts", F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp())
            (log.withColumn("micro_batch", F.lit(micro_batch).cast("long")).coalesce(1).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("micro_batch").parquet(paths.offsets))
        _keep_marks(spark, paths, micro_batch, newest)

    return process


def without_repeats(typed: DataFrame, horizon_s: int) -> DataFrame:
    """Each event once, by the stream's keyed state: an id is remembered for ``horizon_s`` of event time.

    The watermark lets Spark forget older ids, so the state stays as large as one
    horizon's events.  Rows without a readable time or id are let through (ingest counts them).
    """
    whole = F.col("event_id").isNotNull() & F.col("event_ts").isNotNull()
    keyed = typed.withColumn("_key", F.when(whole, F.col("event_id").cast("string")).otherwise(F.uuid()))
    return keyed.withWatermark("event_ts", f"{horizon_s} seconds").dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def landing_stream(spark: SparkSession, landing: str, files_per_trigger: int | None = None) -> DataFrame:
    """All-string landing rows and their drop as a file stream, oldest files first."""
    reader = spark.readStream.schema(DROP_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(landing)


def run_micro_batches(spark: SparkSession, paths: PipelinePaths, files_per_trigger: int | None = None,
                      allowed_lateness_s: int | None = None, run_ts: str | None = None,
                      every: str | None = None, drop_span_s: int = 31 * 86400):
    """Run the ingest pipeline, at most ``files_per_trigger`` files per micro-batch (None: all that have landed).

    ``drop_span_s`` is the event time that one drop covers at most.  Ids are remembered for that
    and the allowed lateness, so rows of a drop that is spread over micro-batches are never late for Spark.

    ``every=None`` processes everything landed so far and stops (a scheduled
    job body); ``every="20 minutes"`` keeps the query running on a fixed
    interval and returns the running query.
    """
    stream = without_repeats(typed_events(landing_stream(spark, paths.landing, files_per_trigger)), drop_span_s + (allowed_lateness_s or 0))
    w = (stream.writeStream.foreachBatch(make_batch_writer(paths, allowed_lateness_s, run_ts))
         .option("checkpointLocation", paths.checkpoint))
    if every:
        return w.trigger(processingTime=every).start()
    w.trigger(availableNow=True).start().awaitTermination()
    return None


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as a file stream, whether it is one file or a folder of files."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return spark.readStream.schema(schema).parquet(path)
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a streaming frame over all available input into a Parquet table, then stop.

    ``complete`` mode rewrites the whole result each batch (for aggregates);
    other modes append.
    """
    if mode == "complete":
        def overwrite(batch: DataFrame, _batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(path)

        w = df.writeStream.outputMode("complete").foreachBatch(overwrite)
    else:
        w = df.writeStream.outputMode(mode).format("parquet").option("path", path)
    q = w.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def run_updating_aggregate(agg: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """Run a watermarked streaming aggregate in update mode; return its current result.

    Each micro-batch appends the rows it changed to partition ``batch_id`` of
    an update log (overwritten on replay, so retries are idempotent).  The
    watermark lets Spark drop state of closed windows, so state stays bounded
    however long the stream runs.  The result is the latest version of every
    key: an aggregate (``max_by`` on ``batch_id``) over the update log.
    """
    def append(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    q = (agg.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    log = spark_read_typed(agg.sparkSession, path)
    values = [c for c in log.columns if c not in keys and c != "batch_id"]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("v"))
    return latest.select(*keys, "v.*")


def spark_read_typed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))


# --------------------------------------------------------------------------- weather as a stream of its own

WEATHER_SCHEMA = "dest int, observed timestamp, mean_temp double, max_temp double, drop int"


def weather_frame(events: DataFrame) -> DataFrame:
    """Hourly weather by destination: mean and highest temperature."""
    dest = (F.col("user_id") % N_AIRPORTS).cast("int")
    return events.groupBy(dest.alias("dest"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour_ts")).agg(
        F.round(F.avg("value"), 6).alias("mean_temp"), F.max("value").alias("max_temp"))


def write_weather_drops(events: DataFrame, root: str, split_ts: str, late: Column, drops: tuple[int, ...] = (0, 1)) -> None:
    """Land hourly observations in two drops; those before the split for which ``late`` holds come with the second."""
    w = weather_frame(events).withColumnRenamed("hour_ts", "observed")
    first = (F.col("observed") < F.lit(split_ts).cast("timestamp")) & ~late
    for i in drops:
        w.where(~first if i else first).write.mode("overwrite").parquet(f"{root}/drop={i}")


def weather_stream(spark: SparkSession, root: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(WEATHER_SCHEMA)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(root)


def with_weather(events: DataFrame, weather: DataFrame, lateness: str = "3 days") -> DataFrame:
    """Interval join of two streams: each event with the observation of its destination whose hour it falls in.

    Both sides have a watermark and the range bounds how long a row can find a
    partner, so Spark keeps an event until weather older than ``lateness`` would be late, and no longer.
    An event's clock hour is that of its observation or the next one, so an observation is kept under both
    and an event meets those of its hour, not all of its destination.
    """
    hour = lambda c: F.floor(F.unix_seconds(c) / 3600)
    e = events.withWatermark("event_ts", lateness).withColumn("_hour", hour("event_ts")).alias("e")
    w = weather.withWatermark("observed", lateness).withColumn("_hour", F.explode(F.array(hour("observed"), hour("observed") + 1))).alias("w")
    within = (F.col("e.event_ts") >= F.col("w.observed")) & (F.col("e.event_ts") < F.col("w.observed") + F.expr("INTERVAL 1 HOUR"))
    same = (F.col("e.dest") == F.col("w.dest")) & (F.col("e._hour") == F.col("w._hour"))
    return e.join(w, same & within).select(*[f"e.{c}" for c in events.columns], "w.observed", "w.mean_temp", "w.max_temp")
