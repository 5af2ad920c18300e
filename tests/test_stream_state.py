"""Marks and duplicates kept in state: flat size, repeats inside and across batches, weather that arrives late."""

from pyspark.sql import functions as F

from contrail.session import scratch_path
from contrail.streaming import pipeline as pl


def _paths(spark, name):
    root = scratch_path(spark, name)
    return pl.PipelinePaths(f"{root}/landing", f"{root}/final", f"{root}/offsets", f"{root}/_checkpoint")


def _land(spark, paths, drop, rows, files=1):
    """rows: (event_id, time text)."""
    df = spark.createDataFrame([(str(i), t) for i, t in rows], "event_id string, ts string")
    df = df.select(*[F.col(c) if c in ("event_id", "ts") else F.lit("1").alias(c) for c in pl.EVENT_COLUMNS])
    df.repartition(files).write.parquet(f"{paths.landing}/drop={drop}")


def _time(minutes):
    return f"2024-01-{1 + minutes // 1440:02d} {minutes // 60 % 24:02d}:{minutes % 60:02d}:00"


def test_repeats_inside_one_batch_and_across_batches(spark):
    paths = _paths(spark, "t-repeat")
    _land(spark, paths, 0, [(1, _time(10)), (1, _time(10)), (2, _time(20)), (3, _time(30))])
    _land(spark, paths, 1, [(2, _time(20)), (4, _time(40)), (4, _time(40)), (None, _time(50)), (None, _time(50))])
    pl.run_micro_batches(spark, paths, files_per_trigger=1, allowed_lateness_s=3600)
    got = sorted((r.event_id or 0, r.batch_id) for r in pl.read_sink(spark, paths).collect())
    assert got == [(0, 1), (0, 1), (1, 0), (2, 0), (3, 0), (4, 1)]


def test_state_stays_flat_over_fifty_drops(spark):
    paths, sizes = _paths(spark, "t-flat"), []
    for d in range(50):
        _land(spark, paths, d, [(d * 10 + i, _time(d * 60 + i)) for i in range(10)] + [(d * 10, _time(d * 60))])
    stream = pl.without_repeats(pl.typed_events(pl.landing_stream(spark, paths.landing, 1)), horizon_s=3 * 3600)
    q = (stream.writeStream.foreachBatch(pl.make_batch_writer(paths)).option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert pl.read_sink(spark, paths).count() == 500
    assert len(sizes) >= 50 and max(sizes[10:]) <= max(sizes[:10]) <= 80
    marks = spark.read.schema(pl._MARKS).parquet(paths.marks).groupBy("micro_batch").count().agg(F.max("count")).first()[0]
    assert marks <= pl.KEPT_DROPS + 1


def test_marks_beyond_the_kept_drops_share_a_row(spark, monkeypatch):
    monkeypatch.setattr(pl, "KEPT_DROPS", 3)
    paths = _paths(spark, "t-marks")
    pl._keep_marks(spark, paths, 0, {d: 100 - d for d in range(8)})
    assert pl._known_marks(spark, paths, 1) == {4: 100, 5: 95, 6: 94, 7: 93}


def test_weather_that_comes_late_still_joins(spark):
    root = scratch_path(spark, "t-weather")
    _land(spark, pl.PipelinePaths(f"{root}/events", "", "", ""), 0, [(1, _time(61)), (2, _time(119)), (3, _time(120)), (4, _time(5))])
    _land(spark, pl.PipelinePaths(f"{root}/events", "", "", ""), 1, [(5, _time(200)), (6, _time(3000))])
    # user_id is 1 for all events, so the destination is 1.
    for drop, rows in enumerate([[(1, _time(0), 1.0, 1.0)], [(1, _time(60), 2.0, 2.0), (1, _time(180), 3.0, 3.0), (2, _time(120), 9.0, 9.0)]]):
        spark.createDataFrame(rows, "dest int, observed string, mean_temp double, max_temp double").select(
            "dest", F.col("observed").cast("timestamp").alias("observed"), "mean_temp", "max_temp").coalesce(1).write.parquet(f"{root}/weather/drop={drop}")
    typed = pl.typed_events(pl.landing_stream(spark, f"{root}/events", 1)).select("event_id", "dest", "event_ts")
    joined = pl.with_weather(typed, pl.weather_stream(spark, f"{root}/weather", 1).drop("drop"))
    pl.run_to_table(joined, f"{root}/out", f"{root}/_ck")
    assert sorted((r.event_id, r.mean_temp) for r in spark.read.parquet(f"{root}/out").collect()) == [(1, 2.0), (2, 2.0), (4, 1.0), (5, 3.0)]
