"""The interval join of events and weather meets observations of the hour only, aligned to the hour or not."""

from contrail.streaming import pipeline as pl


def test_observations_at_any_minute_match_the_range(spark):
    ev = [(i, i % 2, f"2024-01-01 {i % 5 + 10}:{i * 7 % 60:02d}:00") for i in range(60)] + [(99, 0, None)]
    ob = [(i % 2, f"2024-01-01 {9 + i // 2}:{m:02d}:00", float(i)) for i in range(12) for m in (0, 25)]
    e = spark.createDataFrame(ev, "event_id long, dest int, t string").selectExpr("event_id", "dest", "cast(t as timestamp) event_ts")
    w = spark.createDataFrame(ob, "dest int, t string, v double").selectExpr("dest", "cast(t as timestamp) observed", "v mean_temp", "v max_temp")
    got = pl.with_weather(e, w)
    want = e.alias("e").join(w.alias("w"), "dest").where("event_ts >= observed and event_ts < observed + interval 1 hour").select(*got.columns)
    assert got.columns == ["event_id", "dest", "event_ts", "observed", "mean_temp", "max_temp"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
    keys = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_hour" in keys.split("Join Inner", 1)[1].split("\n", 1)[0]
