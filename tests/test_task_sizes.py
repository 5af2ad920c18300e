"""A task's share of a large input stays as it is: repeats, sketches, training rows."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from contrail.operators import scoring as sc
from contrail.plans import analytics, sketches

SMOKE = "/root/testdata/sf0.001"


def test_repeats_are_removed_a_bounded_number_of_rows_a_task(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 300, None if i % 2 else "x") for i in range(900)], "a int, b string")
    monkeypatch.setattr(analytics, "flights", lambda *_: rows)
    monkeypatch.setattr(analytics, "DEDUP_ROWS", 20)
    got = analytics.dedup_rows(spark, SMOKE)
    assert got.rdd.getNumPartitions() >= 45
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.distinct().collect()))


def test_airlines_are_sketched_where_their_rows_meet(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 40, i % 50 + 1, float(i % 50 + 2)) for i in range(4000)], "airline_code int, arrdelay int, x double")
    seen = []
    real = type(rows).repartition
    monkeypatch.setattr(type(rows), "repartition", lambda self, *a: (seen.append(a), real(self, *a))[1])
    monkeypatch.setattr(sketches, "_positive", lambda *_: rows)
    got = sketches.build_sketch_table(spark, SMOKE)
    assert seen and seen[0][0] == "airline_code"
    assert {r.n for r in got.select(F.kll_sketch_get_n_double("sk_arrdelay").alias("n")).collect()} == {100} and got.count() == 40


def test_training_rows_are_dealt_to_more_tasks_as_they_grow(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 9, i % 4, i % 5, i % 50, i % 24, i % 3) for i in range(400)], "uniquecarrier int, origin int, dest int, week int, hour int, y int")
    tasks = []
    real = Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df: (tasks.append(df.rdd.getNumPartitions()), real(self, df))[1])
    monkeypatch.setattr(sc, "FIT_ROWS", 10)
    assert sc.fit(rows, F.col("y") == 0, max_iter=1).stages
    assert tasks == [41]
