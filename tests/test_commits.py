"""Commits of two writers, signed changes, file packing, pruning and stored sketches."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contrail.operators import tables as tbl
from contrail.session import scratch_path
from tests.conftest import SF_SMALL


def _interleave(monkeypatch, other):
    """The first commit finds that another writer has committed between its look at the log and its own entry."""
    real, state = tbl.publish, {"left": 1}

    def late(spark, row, target):
        if state["left"]:
            state["left"] = 0
            other()
        return real(spark, row, target)

    monkeypatch.setattr(tbl, "publish", late)


def test_two_writers_of_snapshots(spark, monkeypatch):
    st_ = tbl.SnapshotTable(scratch_path(spark, "t-two"))
    st_.append(spark, spark.range(0, 5), "2024-01-01 00:00:00")
    other = tbl.SnapshotTable(st_.root)
    _interleave(monkeypatch, lambda: other.append(spark, spark.range(100, 107), "2024-01-02 00:00:00"))
    assert st_.append(spark, spark.range(5, 8), "2024-01-03 00:00:00") == 3
    assert sorted(r.id for r in st_.read(spark).collect()) == [*range(0, 8), *range(100, 107)]
    got = [(r.snapshot_id, r.parent_id, r.rows_added) for r in st_.history(spark).orderBy("snapshot_id").collect()]
    assert got == [(1, None, 5), (2, 1, 7), (3, 2, 3)]
    assert {r.snapshot_id: r["count"] for r in st_.read(spark).groupBy("snapshot_id").count().collect()} == {1: 5, 2: 7, 3: 3}


def test_two_writers_of_references(spark, monkeypatch):
    refs = tbl.TableRefs(scratch_path(spark, "t-refs2"))
    refs.set(spark, "main", "a", "2024-01-01 00:00:00")
    _interleave(monkeypatch, lambda: refs.set(spark, "main", "b", "2024-01-02 00:00:00"))
    refs.set(spark, "branch", "c", "2024-01-03 00:00:00")
    assert (refs.resolve(spark, "main"), refs.resolve(spark, "branch")) == ("b", "c")
    assert sorted(r.seq for r in spark.read.parquet(refs.root).collect()) == [0, 1, 2]


def _years(spark):
    return spark.range(0, 600).select((F.col("id") % 3 + 2000).alias("year"), F.col("id"), (F.col("id") % 7).alias("v"))


def test_writers_of_other_partitions_do_not_disturb_each_other(spark, monkeypatch):
    t = tbl.VersionedTable.create(spark, _years(spark), scratch_path(spark, "t-cc"), ["year"])
    _interleave(monkeypatch, lambda: t.delete(spark, F.col("year") == 2001))
    t.update(spark, (F.col("year") == 2002) & (F.col("v") == 0), {"v": F.lit(50)})
    got = t.read(spark)
    assert got.where("year = 2001").count() == 0 and got.where("v = 50").count() > 0 and got.count() == 400


def test_writers_of_one_partition_conflict(spark, monkeypatch):
    t = tbl.VersionedTable.create(spark, _years(spark), scratch_path(spark, "t-cc2"), ["year"])
    _interleave(monkeypatch, lambda: t.delete(spark, (F.col("year") == 2002) & (F.col("v") == 1)))
    with pytest.raises(tbl.CommitConflict):
        t.update(spark, (F.col("year") == 2002) & (F.col("v") == 0), {"v": F.lit(50)})
    assert t.read(spark).where("v = 50").count() == 0 and t.read(spark).where("year = 2002 and v = 1").count() == 0


def test_rewrites_replace_folders_and_keep_none(spark):
    """Five updates of one partition and a compaction leave one folder a partition, not a layer each."""
    t = tbl.VersionedTable.create(spark, _years(spark), scratch_path(spark, "t-flat"), ["year"])
    for i in range(5):
        t.update(spark, (F.col("year") == 2000) & (F.col("v") == 0), {"v": F.lit(0)})
    t.compact(spark)
    _, folders, _ = t._state(spark)
    assert len(folders) == 3 and t.read(spark).count() == 600


def test_signed_changes_add_up(spark):
    t = tbl.VersionedTable.create(spark, _years(spark), scratch_path(spark, "t-signed"), ["year"])
    before = t.read(spark)
    start = t.version(spark)
    t.update(spark, F.col("v") == 3, {"v": F.lit(30), "year": F.lit(2002)})  # rows move between partitions
    t.delete(spark, F.col("v") == 5)
    t.insert(spark, spark.range(1000, 1010).select(F.lit(2005).cast("long").alias("year"), "id", F.lit(1).cast("long").alias("v")))
    t.compact(spark)
    signed = t.changes(spark, start).groupBy("year", "id", "v").agg(F.sum("weight").alias("w"))
    back = before.select("year", "id", "v", F.lit(1).alias("w")).unionByName(signed).groupBy("year", "id", "v").agg(F.sum("w").alias("w")).where("w <> 0")
    assert {tuple(r) for r in back.collect()} == {(r.year, r.id, r.v, 1) for r in t.read(spark).collect()}
    assert t.changes(spark, t.version(spark)).count() == 0


def test_rollup_of_a_group_that_vanishes_and_returns(spark):
    from contrail.plans.maintenance import MaintainedRollup, build_rollup

    f = spark.createDataFrame([(2000, 1, 7, 0, 5), (2000, 1, 7, 1, None), (2000, 2, 8, 0, -3), (2001, 2, 8, 0, 9), (2001, 3, None, 0, 1)],
                              "year int, month int, uniquecarrier int, cancelled int, depdelay int")
    al = spark.createDataFrame([(7, "A"), (8, "B")], "code int, description string")
    t = tbl.VersionedTable.create(spark, f, scratch_path(spark, "t-roll"), ["year"])
    r = MaintainedRollup.build(spark, t, al)
    steps = [lambda: t.delete(spark, F.col("month") == 1), lambda: t.update(spark, F.col("depdelay") > 5, {"depdelay": F.lit(0)}),
             lambda: t.insert(spark, f.where("month = 1")), lambda: t.update(spark, F.col("month") == 2, {"uniquecarrier": F.lit(7)}), lambda: t.delete(spark, F.lit(True))]
    for step in steps:
        step()
        r = r.refresh(spark, al)
        assert sorted(map(tuple, r.read(spark).collect()), key=str) == sorted(map(tuple, build_rollup(t.read(spark), al).collect()), key=str)
    assert r.read(spark).count() == 0


@given(st.lists(st.integers(1, 100), max_size=40))
def test_first_fit_decreasing(sizes):
    items = [(s, f"f{i}") for i, s in enumerate(sizes)]
    bins = tbl.first_fit_decreasing(items, 100)
    assert sorted(x for b in bins for x in b) == sorted(items)
    assert all(sum(s for s, _ in b) <= 100 for b in bins)
    assert len(bins) <= 1 or sum(1 for b in bins if sum(s for s, _ in b) <= 50) <= 1


def test_packing_leaves_other_files_where_they_are(spark):
    t = tbl.VersionedTable.create(spark, spark.range(0, 40000).select((F.col("id") % 2 + 2000).alias("year"), "id", F.rand(3).alias("x")),
                                  scratch_path(spark, "t-pack"), ["year"], files_per_partition=1)
    small = spark.range(0, 30).select(F.lit(2000).cast("long").alias("year"), "id", F.lit(0.5).alias("x"))
    t.insert(spark, small, files_per_partition=3)          # three small files in one folder
    t.insert(spark, small.withColumn("year", F.lit(2001).cast("long")), files_per_partition=1)  # one alone: nothing to merge with
    rows, before = sorted(map(tuple, t.read(spark).collect())), {r.file for r in t.file_sizes(spark).collect()}
    read = {r.file for r in t.compact_small_files(spark, target_bytes=100_000).collect()}
    after = {r.file for r in t.file_sizes(spark).collect()}
    assert len(read) == 3 and before - after == read and len(after - before) == 1
    assert sorted(map(tuple, t.read(spark).collect())) == rows
    t.update(spark, F.col("x") == 0.5, {"x": F.lit(0.25)})  # entries that are single files can be rewritten too
    assert t.read(spark).where("x = 0.25").count() == 60 and t.read(spark).count() == len(rows)
    assert t.compact_small_files(spark, target_bytes=10).count() == 0


def _scan_metric(df, name):
    """Sum of a metric over the file scans of an executed plan."""
    def seq(s):
        return [s.apply(i) for i in range(s.size())]

    def walk(p):
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(p.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(p.plan())
        own = p.metrics().apply(name).value() if "Scan" in kind and p.metrics().contains(name) else 0
        return own + sum(walk(c) for c in seq(p.children()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_calendar_filter_prunes_the_fact(spark):
    from contrail.plans.maintenance import calendar, quarters
    from contrail.sources.tables import flights

    f, cal = flights(spark, SF_SMALL), calendar(spark, SF_SMALL)
    some = quarters(f, cal, (F.col("quarter") == 2) & F.col("odd_year"))
    assert "dynamicpruning" in some._jdf.queryExecution().toString().lower()
    some.collect()
    every = quarters(f, cal, F.lit(True))
    every.collect()
    months = cal.where("quarter = 2 and odd_year").count()
    of_all = cal.count()
    assert 0 < _scan_metric(some, "numFiles") < _scan_metric(every, "numFiles") * 2 * months / of_all + 2


def test_newest_partition_needs_no_job(spark):
    from contrail.plans.maintenance import newest_partition
    from contrail.sources.tables import flights

    f = flights(spark, SF_SMALL)
    want = f.agg(F.max(F.struct("year", "month")).alias("m")).first()["m"]
    assert newest_partition(f) == (want["year"], want["month"])


def test_periods_are_answered_without_the_fact(spark):
    from contrail.plans import sketches as ps

    quantiles, items = ps.sketch_history(spark, SF_SMALL)
    for df in (ps.period_quantiles(quantiles, ps.PERIODS), ps.period_items(items, ps.PERIODS)):
        assert all("history-" in f for f in df.inputFiles())


def test_rejected_lines_are_kept(spark):
    from contrail.sources import delimited as dl

    path, lines = scratch_path(spark, "t-rej"), ["1,a,2", "x,b,3", "2,c", "3,d,4,5", ",e,", "4,f,9999999999999", "5,\"g\",6", "1.5,h,7"]
    dl.write_raw_lines(spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1), "k,s,n", path)
    good, bad = dl.read_with_rejects(spark, path, "k long, s string, n int")
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, "a", 2), (None, "e", None), (5, '"g"', 6)], key=str)
    got = {r.line: r.reason for r in bad.collect()}
    assert got == {"x,b,3": "k", "2,c": "fields", "3,d,4,5": "fields", "4,f,9999999999999": "n", "1.5,h,7": "k"}
    assert tuple(good.agg(F.count(F.lit(1)), F.sum("n")).first()) == (3, 8)  # the same lines when one column is read
    assert good.count() + bad.count() == len(lines) and bad.where("file is null").count() == 0
