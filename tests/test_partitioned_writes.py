"""Partitioned writes: bands from counts, files kept open instead of a sort, single files without a shuffle."""

from pyspark.sql import functions as F

from contrail.operators import tables as tbl
from contrail.plans.maintenance import partition_evolution
from contrail.session import scratch_path
from contrail.sources import tables as st


def _rows(spark):
    return spark.createDataFrame([(2000 + i % 3 if i % 7 else None, 1 + i % 2, i) for i in range(2000)], "year int, month int, v long")


def test_writers_run_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df, path = _rows(spark), scratch_path(spark, "t-once")
    watched = df.mapInArrow(watch, df.schema)
    tbl.write_range_partitioned(watched, path, ["year", "month"], ["v"], 4, df, lambda d: d.withColumn("w", F.col("v") + 1))
    assert seen.value == 2000
    got = spark.read.parquet(path).select("year", "month", "v").collect()
    assert sorted(map(str, got)) == sorted(map(str, df.collect()))


def test_rows_of_uncounted_partitions_are_written(spark):
    df, path = _rows(spark), scratch_path(spark, "t-uncounted")
    tbl.write_range_partitioned(df, path, ["year"], ["v"], 4, df.where("year = 2001"))
    assert spark.read.parquet(path).count() == 2000


def test_partitioned_writes_do_not_sort(spark):
    from contrail.session import apply_core_conf
    apply_core_conf(spark)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 1


def test_single_files_come_from_a_task_each_without_a_shuffle(spark, monkeypatch):
    src = scratch_path(spark, "t-source")
    _rows(spark).repartition(3).write.partitionBy("year", "month").parquet(src)
    stored = spark.read.schema("v long, year int, month int").parquet(src)
    monkeypatch.setattr(tbl, "write_exact", lambda *a: (_ for _ in ()).throw(AssertionError("shuffled")))
    t = tbl.VersionedTable.create(spark, stored, scratch_path(spark, "t-single"), ["year"], files_per_partition=1)
    files = t.read(spark).inputFiles()
    assert len(files) == 4 and len({f.rsplit("/", 1)[1].split("-")[1] for f in files}) == 4
    assert sorted(map(str, t.read(spark).select("v", "year", "month").collect())) == sorted(map(str, stored.collect()))


def test_only_base_columns_travel_to_the_writers(spark):
    d = "/root/testdata/sf0.001"
    base = st._flight_base(spark, d)
    assert len(base.columns) < len(st.FLIGHT_COLUMNS) / 1.5
    assert st.flights_plan(spark, d).columns == st._flight_columns(base).columns
    assert sorted(map(str, st.flights(spark, d).collect())) == sorted(map(str, st.flights_plan(spark, d).select(*st.FLIGHT_COLUMNS).collect()))


def test_coarse_layout_is_written_where_it_is_read(spark, monkeypatch):
    dealt = []
    monkeypatch.setattr(tbl, "write_range_partitioned", lambda df, path, by, *a, real=tbl.write_range_partitioned: (dealt.append(by), real(df, path, by, *a)))
    d = "/root/testdata/sf0.001"
    got = partition_evolution(spark, d)
    assert dealt == [["year", "month", "dayofmonth"]]
    assert got.agg(F.sum("n_rows")).first()[0] == st.flights(spark, d).count()
