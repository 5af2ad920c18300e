"""Operator tests on literal fixtures, goldens from the labs, invariants and metamorphic checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from contrail.functions.scalars import event_text, event_ts, kv_fixed_width, kv_number, parse_event_text
from contrail.operators import protect as pr
from contrail.operators import quality as qa
from contrail.operators import scd2
from contrail.operators import tables as tbl
from contrail.operators.joins import dim_join, size_bound
from contrail.operators.ranking import dense_sequence, ranked_string, top_n_per_group
from contrail.session import scratch_path
from tests.conftest import SF_SMALL

# ---------------------------------------------------------------- SCD2 golden (four rows of the lab)


def test_scd2_merge_a_golden(spark):
    # fixed values from the lab: two carriers, one update, one delete, one insert
    airlines = spark.createDataFrame([("02Q", "Titan Airways"), ("04Q", "Tradewind Aviation")],
                                     "code string, description string")
    stage = spark.createDataFrame([("02Q", "Update - TITAN AIRWAYS"), ("FFF", "New Airline")],
                                  "code string, description string")
    dim = scd2.initial_load(airlines, scd2.VARIANT_A, "2021-01-01 00:00:00", "2021-01-01 00:00:00")
    now = "2024-04-11 12:06:15.649675"
    out = scd2.merge(dim, stage, now, scd2.VARIANT_A)
    got = sorted((r.code, r.description, str(r.valid_from), str(r.valid_to)) for r in out.collect())
    assert got == [
        ("02Q", "Titan Airways", "2021-01-01 00:00:00", "2024-04-11 12:06:15.649675"),
        ("02Q", "Update - TITAN AIRWAYS", "2024-04-11 12:06:15.649675", "9999-01-01 00:00:00"),
        ("04Q", "Tradewind Aviation", "2021-01-01 00:00:00", "2024-04-11 12:06:15.649675"),
        ("FFF", "New Airline", "2024-04-11 12:06:15.649675", "9999-01-01 00:00:00"),
    ]
    # Re-running the same merge later changes nothing: history is never re-closed.
    again = scd2.merge(out, stage, "2025-01-01 00:00:00", scd2.VARIANT_A)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_scd2_change_feed_tags(spark):
    dim = scd2.initial_load(spark.createDataFrame([("A", "x"), ("B", "y")], "code string, description string"),
                            scd2.VARIANT_A, "2021-01-01 00:00:00", "2021-01-01 00:00:00")
    stage = spark.createDataFrame([("A", "x2"), ("C", "z")], "code string, description string")
    got = sorted((r.ops, r.join_key, r.code) for r in scd2.change_feed(dim, stage).collect())
    assert got == [("delete", "B", "B"), ("insert", None, "C"), ("update - change the old row", "A", "A"),
                   ("update - insert row", None, "A")]


# ---------------------------------------------------------------- emp ⨝ dept golden


def test_values_join_emp_golden(spark):
    # fixed values from the lab: departments and employees
    dept = spark.createDataFrame([
        (10, "ACCOUNTING", "NEW YORK"), (20, "RESEARCH", "DALLAS"), (30, "SALES", "CHICAGO"),
        (40, "OPERATIONS", "BOSTON")], "deptno int, dname string, loc string")
    emp = spark.createDataFrame([
        (7369, "SMITH", "CLERK", 7902, "1993-6-13", 800.0, 0.0, 20),
        (7499, "ALLEN", "SALESMAN", 7698, "1998-8-15", 1600.0, 300.0, 30),
        (7521, "WARD", "SALESMAN", 7698, "1996-3-26", 1250.0, 500.0, 30),
        (7566, "JONES", "MANAGER", 7839, "1995-10-31", 2975.0, None, 20),
        (7698, "BLAKE", "MANAGER", 7839, "1992-6-11", 2850.0, None, 30),
        (7782, "CLARK", "MANAGER", 7839, "1993-5-14", 2450.0, None, 10),
        (7788, "SCOTT", "ANALYST", 7566, "1996-3-5", 3000.0, None, 20),
        (7839, "KING", "PRESIDENT", None, "1990-6-9", 5000.0, 0.0, 10),
        (7844, "TURNER", "SALESMAN", 7698, "1995-6-4", 1500.0, 0.0, 30),
        (7876, "ADAMS", "CLERK", 7788, "1999-6-4", 1100.0, None, 20),
        (7900, "JAMES", "CLERK", 7698, "2000-6-23", 950.0, None, 30),
        (7934, "MILLER", "CLERK", 7782, "2000-1-21", 1300.0, None, 10),
        (7902, "FORD", "ANALYST", 7566, "1997-12-5", 3000.0, None, 20),
        (7654, "MARTIN", "SALESMAN", 7698, "1998-12-5", 1250.0, 1400.0, 30),
    ], "empno int, ename string, job string, mgr int, hiredate string, sal double, comm double, deptno int")
    emp = emp.withColumn("hiredate", F.to_date("hiredate", "y-M-d")).withColumn("sal", F.col("sal").cast("decimal(7,2)"))
    out = dim_join(emp, dept, "deptno").select("ename", "dname", "job", "empno", "hiredate", "loc").orderBy("ename")
    rows = [(r.ename, r.dname, r.job, r.empno, str(r.hiredate), r.loc) for r in out.collect()]
    assert len(rows) == 14
    assert rows[0] == ("ADAMS", "RESEARCH", "CLERK", 7876, "1999-06-04", "DALLAS")
    assert rows[-1] == ("WARD", "SALES", "SALESMAN", 7521, "1996-03-26", "CHICAGO")
    assert rows[7] == ("KING", "ACCOUNTING", "PRESIDENT", 7839, "1990-06-09", "NEW YORK")


# ---------------------------------------------------------------- AES golden


def test_aes_ecb_matches_published_ciphertext(spark):
    # fixed values from the lab: key, plaintext and the printed ciphertext
    df = spark.createDataFrame([("AIRBUS",)], "m string")
    row = df.select(pr.aes_encrypt_b64("m", "1234567890123456").alias("c")).first()
    assert row.c == "HIL21crGdEnSYvLIqiKzNQ=="
    back = df.select(pr.aes_decrypt_b64(pr.aes_encrypt_b64("m", "1234567890123456"), "1234567890123456").alias("p"))
    assert back.first().p == "AIRBUS"


# ---------------------------------------------------------------- scalars


def test_event_time_edges(spark):
    df = spark.createDataFrame([(2023, 1, 1, 5), (2023, 1, 1, 2400), (2023, 12, 31, 2400), (2023, 2, 30, 1200),
                                (2023, 1, 1, 1275), (2023, 1, 1, None)], "y int, m int, d int, t int")
    out = df.select(event_ts("y", "m", "d", "t").alias("ts"), event_text("y", "m", "d", "t").alias("txt"))
    rows = out.collect()
    assert rows[0].ts == dt.datetime(2023, 1, 1, 0, 5)
    assert rows[0].txt == "2023-1-1 00:05:00"
    assert rows[1].ts == dt.datetime(2023, 1, 2, 0, 0)       # 24:00 is next-day midnight
    assert rows[2].ts == dt.datetime(2024, 1, 1, 0, 0)
    assert rows[3].ts is None and rows[4].ts is None and rows[5].ts is None  # impossible date / minute / NULL
    parsed = spark.createDataFrame([("2023-1-1 00:05:00",), ("2023-13-1 00:05:00",), ("",)], "s string").select(
        parse_event_text("s").alias("e")).collect()
    assert parsed[0].e == 1672531500 and parsed[1].e is None and parsed[2].e is None


def test_kv_parse(spark):
    odd = spark.createDataFrame([("{temp=1.5E-4, speed=1.25E7}",)], "w string").select(kv_number("w", "temp"), kv_number("w", "speed"))
    assert tuple(odd.first()) == (1.5e-4, 1.25e7)
    df = spark.createDataFrame([("{temp=12.5, pressure=1013.2, humidity=100}",), ("{pressure=990}",)], "w string")
    r = df.select(kv_number("w", "temp").alias("t"), kv_number("w", "humidity").alias("h"),
                  kv_fixed_width("w", "humidity", 2, "}").alias("hf"), kv_number("w", "speed").alias("s")).collect()
    assert r[0].t == 12.5 and r[0].h == 100.0 and r[0].s is None
    assert r[0].hf == "10"          # the fixed-width read truncates three-digit values
    assert r[1].t is None


# ---------------------------------------------------------------- quality


def test_gate_raises_and_warns(spark):
    docs = spark.createDataFrame([(1, 'a "q"'), (2, "b"), (3, "b")], "id long, text string")
    ok = qa.run_tests([qa.unique_test(docs, "id", "id_unique")])
    assert qa.gate(ok).passed == ["id_unique"]
    warn = qa.run_tests([qa.pattern_test(docs, "text", '"', "quotes", 0, 10)])
    assert qa.gate(warn, log=lambda m: None).warned == ["quotes"]
    bad = qa.run_tests([qa.unique_test(docs, "text", "text_unique", hash_long_text=True)])
    with pytest.raises(qa.DataQualityError):
        qa.gate(bad)
    with pytest.raises(qa.DataQualityError):
        qa.gate(ok.where("false"))


def test_cleanse_keeps_null_condition_rows(spark):
    df = spark.createDataFrame([("ABC", 'x"y'), ("ABCD", "z"), (None, "w")], "code string, name string")
    got = sorted(map(tuple, qa.cleanse(df, "name", '"', "code", 3).collect()), key=str)
    assert got == [("ABC", "xy"), (None, "w")]


def test_table_check_fails_by_design(spark):
    r = qa.table_checks(spark.range(25), "t", {"min_rows": ("geq_to", 10000), "range": ("between", (1, 100))})
    assert {x.check: x.passed for x in r.collect()} == {"min_rows": False, "range": True}


# ---------------------------------------------------------------- ids and ranking


def test_dense_sequence_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7 % 5000).alias("k"))
    out = dense_sequence(df, ["k"]).collect()
    ids = sorted((r.id, r.k) for r in out)
    assert [i for i, _ in ids] == list(range(1, 5001))
    assert [k for _, k in ids] == sorted(k for _, k in ids)


def test_top_n_with_a_hot_group(spark):
    # one key holds most rows: the window keeps n per group without collecting the group
    rows = [("hot", i, float(i)) for i in range(3000)] + [("cold", i, float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, item long, v double").repartition(8)
    top = top_n_per_group(df, ["g"], [F.desc("v"), F.asc("item")], 3)
    s = ranked_string(top, ["g"], "rn", F.concat(F.col("item").cast("string"), F.lit(";")), "s")
    assert {r.g: r.s for r in s.collect()} == {"hot": "2999;2998;2997;", "cold": "4;3;2;"}


def test_dim_join_broadcasts_only_proven_small_sides(spark):
    fact = spark.range(0, 1000).withColumnRenamed("id", "k")
    dim = spark.range(0, 10).withColumnRenamed("id", "k")
    assert size_bound(dim) == (10, 80)
    small = dim_join(fact, dim, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in small
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = dim_join(fact, dim, "k", max_rows=5)._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in big
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ---------------------------------------------------------------- tables


def _files(spark, t):
    return {r.year: r.files for r in t.layout(spark).collect()}


def _rows(spark, t, *cols):
    return sorted(map(tuple, t.read(spark).select(*cols).collect()), key=str)


def test_update_inverse_is_identity_and_delete_empties_partition(spark):
    df = spark.range(0, 600).select((F.col("id") % 3 + 2000).alias("year"), F.col("id"), (F.col("id") % 7).alias("v"))
    t = tbl.VersionedTable.create(spark, df, scratch_path(spark, "t-dml"), ["year"])
    before = _rows(spark, t, "id", "v", "year")
    t.update(spark, F.col("v") > 3, {"v": F.col("v") + 100})
    t.update(spark, F.col("v") > 100, {"v": F.col("v") - 100})
    assert _rows(spark, t, "id", "v", "year") == before
    t.delete(spark, F.col("year") == 2001)
    after = t.read(spark)
    assert after.where("year = 2001").count() == 0 and after.count() == 400
    assert t.read(spark, version=0).count() == 600       # earlier versions stay readable


def test_update_may_move_rows_between_partitions(spark):
    df = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (2, 21)], "k int, v int")
    t = tbl.VersionedTable.create(spark, df, scratch_path(spark, "t-move"), ["k"])
    t.update(spark, F.col("v") == 11, {"k": F.lit(2)})
    assert _rows(spark, t, "k", "v") == [(1, 10), (2, 11), (2, 20), (2, 21)]
    t.update(spark, F.col("k") == 1, {"k": F.lit(3)})    # a partition whose rows all move leaves nothing behind
    assert _rows(spark, t, "k", "v") == [(2, 11), (2, 20), (2, 21), (3, 10)]


def test_null_and_escaped_partitions(spark):
    df = spark.createDataFrame([(None, 10), ("a:b", 1), ("a:b", 2), ("c/d", 3), ("e", 4)], "k string, v int")
    t = tbl.VersionedTable.create(spark, df, scratch_path(spark, "t-null"), ["k"])
    t.update(spark, F.col("v") == 10, {"v": F.lit(11)})
    assert _rows(spark, t, "v") == [(1,), (11,), (2,), (3,), (4,)]
    t.delete(spark, F.col("k") == "a:b")
    t.delete(spark, F.col("k") == "c/d")
    t.delete(spark, F.col("v") == 11)
    assert _rows(spark, t, "k", "v") == [("e", 4)]
    two = spark.createDataFrame([(1, None, 1), (1, "x", 2), (None, "x", 3)], "a int, b string, v int")
    u = tbl.VersionedTable.create(spark, two, scratch_path(spark, "t-null2"), ["a", "b"])
    u.delete(spark, F.col("v") != 2)
    assert _rows(spark, u, "a", "b", "v") == [(1, "x", 2)]


def test_compaction_keeps_rows_and_reduces_files(spark):
    df = spark.range(0, 3000).select((F.col("id") % 2 + 1999).alias("year"), "id")
    t = tbl.VersionedTable.create(spark, df, scratch_path(spark, "t-compact"), ["year"], files_per_partition=6)
    files_before = _files(spark, t)
    rows_before = _rows(spark, t, "id")
    t.compact(spark, where=F.col("year") == 1999)
    files_after = _files(spark, t)
    assert files_before == {1999: 6, 2000: 6}
    assert files_after == {1999: 1, 2000: 6}
    assert _rows(spark, t, "id") == rows_before


@pytest.mark.parametrize("width", ["1", "3", "8", "50"])
def test_layout_does_not_depend_on_the_shuffle_width(spark, width):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        df = spark.range(0, 7000).select((F.col("id") % 7 + 1992).cast("int").alias("year"), "id")
        t = tbl.VersionedTable.create(spark, df, scratch_path(spark, "t-layout"), ["year"], files_per_partition=2)
        assert set(_files(spark, t).values()) == {2}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_unreadable_log_is_an_error_not_an_empty_table(spark):
    st = tbl.SnapshotTable(scratch_path(spark, "t-broken"))
    st.append(spark, spark.range(0, 5), "2024-01-01 00:00:00")
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(st.log_path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(st.log_path)):
        if f.getPath().getName().endswith(".parquet"):
            out = fs.create(f.getPath(), True)
            out.writeBytes("not parquet")
            out.close()
    with pytest.raises(Exception):
        st.append(spark, spark.range(5, 7), "2024-01-02 00:00:00")
    assert spark.read.parquet(st.data_path).count() == 5   # the committed snapshot is untouched


def test_snapshot_time_travel_and_orphans(spark):
    st = tbl.SnapshotTable(scratch_path(spark, "t-snap"))
    st.append(spark, spark.range(0, 10), "2024-01-01 00:00:00")
    st.append(spark, spark.range(10, 25), "2024-01-02 00:00:00")
    assert st.read(spark, version=1).count() == 10
    assert st.read(spark, as_of="2024-01-01 12:00:00").count() == 10
    assert st.read(spark).count() == 25
    # an attempt that wrote data but never committed is invisible and is replaced by the next append
    spark.range(100, 200).withColumn("snapshot_id", F.lit(3).cast("long")).write.mode("append") \
        .partitionBy("snapshot_id").parquet(st.data_path)
    assert st.read(spark).count() == 25
    assert st.append(spark, spark.range(25, 30), "2024-01-03 00:00:00") == 3
    assert st.read(spark).count() == 30
    assert [r.total_rows for r in st.history(spark).orderBy("snapshot_id").collect()] == [10, 25, 30]


# ---------------------------------------------------------------- protection


def test_tags_follow_the_plan(spark):
    cust = pr.tag(spark.createDataFrame([(1, "Ann", 3.0)], "id long, name string, bal double"), {"name": {"PII"}})
    policy = pr.Policy(denied_tags={"analyst": {"PII"}}, open_roles={"steward"})
    derived = cust.select("id", F.col("name").alias("n2"), F.upper("name").alias("up"), "bal")
    assert {c for c, t in pr.lineage_tags(derived).items() if "PII" in t} == {"n2", "up"}
    assert pr.enforce_tags(derived, policy, "analyst").columns == ["id", "bal"]
    assert pr.enforce_tags(derived, policy, "steward").columns == derived.columns
    with pytest.raises(pr.AccessDenied):
        pr.enforce_tags(derived, policy, "analyst", requested=["up"])
    per = derived.groupBy("id").agg(F.max("up").alias("m"), F.count("*").alias("n"))
    assert pr.enforce_tags(per, policy, "analyst").columns == ["id", "n"]
    both = derived.select("id", F.lit("x").alias("v")).union(derived.select("id", "up"))
    assert pr.enforce_tags(both, policy, "analyst").columns == ["id"]
    parts = derived.select("id", F.explode(F.split("up", "n")).alias("piece"))
    assert pr.enforce_tags(parts, policy, "analyst").columns == ["id"]
    joined = cust.alias("a").join(derived.alias("b"), F.col("a.id") == F.col("b.id")).select("a.id", F.concat("b.up", F.lit("!")).alias("c"))
    assert pr.enforce_tags(joined, policy, "analyst").columns == ["id"]
    foreign = derived.mapInPandas(lambda it: it, derived.schema)            # origin not shown: counts as tagged
    assert pr.enforce_tags(foreign, policy, "analyst").columns == []


def test_unknown_roles_are_refused(spark):
    df = spark.createDataFrame([(1, "Ann")], "id long, name string")
    policy = pr.Policy(masks={"analyst": {"name": "hash"}}, row_filters={"eu": "id = 1"}, denied_tags={"analyst": {"PII"}})
    for f in (pr.apply_masks, pr.apply_row_filter, pr.enforce_tags):
        with pytest.raises(pr.AccessDenied):
            f(df, policy, "stranger")


# ---------------------------------------------------------------- sketches, scoring (rows-only keys)


def test_frequent_items_against_brute_force(spark):
    from contrail.plans.sketches import frequent_flights
    from contrail.sources.tables import flights

    flight = F.concat(F.col("uniquecarrier").cast("string"), F.lit("-"), F.col("flightnum").cast("string"))
    exact = {(r.cancelled, r.f): r.n for r in flights(spark, SF_SMALL).groupBy("cancelled", flight.alias("f"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    for map_size in (8192, 64):                                  # 64: the sketch has to throw items out
        got = frequent_flights(spark, SF_SMALL, map_size).collect()
        assert got == sorted(got, key=lambda r: (r.cancelled, -r.estimate, r.item))
        for r in got:
            assert r.exact_count == exact[(r.cancelled, r.item)] > r.error
            assert r.within_bounds and r.lower <= r.exact_count <= r.upper
        errors = {r.cancelled: r.error for r in got}
        sure = {k for k, n in exact.items() if k[0] in errors and n > 2 * errors[k[0]]}
        assert sure <= {(r.cancelled, r.item) for r in got}
        if map_size == 8192:
            assert {(r.cancelled, r.item) for r in got} == set(exact)


def test_score_delay_domain(spark):
    from contrail.plans.scoring import metrics, scored_delay

    df = scored_delay(spark, SF_SMALL).cache()
    bad = df.where("prediction NOT IN (0, 1) OR proba < 0.5 OR proba > 1 OR prediction_delay < 0 "
                   "OR prediction_delay > 50 OR (prediction = 0 AND prediction_delay <> 0) "
                   "OR (prediction = 1 AND prediction_delay = 0)")
    assert bad.count() == 0
    assert df.where("prediction = 1").count() > 0 and df.where("prediction = 0").count() > 0
    assert {r.prediction for r in metrics(df).collect()} == {0, 1}


# ---------------------------------------------------------------- SQL on the star views


def test_star_views_answer_sql(spark):
    """Two questions asked in SQL on the views give the rows that plain Python finds in the same views."""
    from collections import defaultdict

    from contrail.sources.tables import register_star_views

    register_star_views(spark, SF_SMALL)
    per = defaultdict(int)
    for r in spark.table("flights").select("tailnum", "depdelay").collect():
        per[r.tailnum] += r.depdelay or 0
    best = sorted(per.items(), key=lambda x: (-x[1], x[0]))[:3]
    got = spark.sql("SELECT tailnum, sum(coalesce(depdelay, 0)) AS s FROM flights GROUP BY tailnum ORDER BY s DESC, tailnum LIMIT 3").collect()
    assert [tuple(r) for r in got] == best
    country = {r.iata: r.country for r in spark.table("airports").collect()}
    abroad = sum(country[r.origin] != country[r.dest] for r in spark.table("flights").select("origin", "dest").collect())
    sql = """SELECT count(*) AS n FROM flights f
             WHERE (SELECT country FROM airports a WHERE a.iata = f.origin) <> (SELECT country FROM airports a WHERE a.iata = f.dest)"""
    assert spark.sql(sql).first().n == abroad


def test_stream_runs_on_an_interval(spark):
    from contrail.plans.streams import SPLIT_TS
    from contrail.sources.tables import table
    from contrail.streaming import pipeline as pl

    root = scratch_path(spark, "t-interval")
    paths = pl.PipelinePaths(f"{root}/landing", f"{root}/final", f"{root}/offsets", f"{root}/_ck")
    pl.write_landing_drops(spark, table(spark, SF_SMALL, "events"), paths.landing, SPLIT_TS)
    q = pl.run_micro_batches(spark, paths, every="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(paths.sink).count() == table(spark, SF_SMALL, "events").count()


def _drop_report(spark, files_per_drop, files_per_trigger):
    from contrail.plans import streams
    from contrail.streaming import pipeline as pl

    paths = streams._pipeline(spark, SF_SMALL, files_per_drop=files_per_drop, files_per_trigger=files_per_trigger)
    offsets = sorted(map(tuple, pl.read_offsets(spark, paths).select("batch_id", "from_ts", "to_ts", "row_count", "late_rows", "rejected_rows").collect()))
    return offsets, sorted(r.event_id for r in pl.read_sink(spark, paths).select("event_id").collect())


def test_files_per_drop_and_batch_change_nothing(spark):
    """The mark moves with the drops, so files and micro-batches may cut them anyhow; checked against DuckDB."""
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    want = sorted(con.execute(entry.oracle_sql()["stream_micro_batch_offsets"]).fetchall())
    first = None
    for files, trigger in ((1, 1), (3, 1), (3, 2), (7, None), (None, None)):
        offsets, ids = _drop_report(spark, files, trigger)
        assert [o[:4] for o in offsets] == want
        assert len(ids) == len(set(ids)) == sum(o[3] for o in offsets)
        first = first or (offsets, ids)
        assert (offsets, ids) == first


def test_rows_without_a_readable_time_are_counted(spark):
    from contrail.streaming import pipeline as pl

    root = scratch_path(spark, "t-reject")
    paths = pl.PipelinePaths(f"{root}/landing", f"{root}/final", f"{root}/offsets", f"{root}/_ck")
    row = lambda i, ts: (str(i), ts, *["0"] * (len(pl.EVENT_COLUMNS) - 2))
    drops = [[row(1, "2024-01-01 00:00:10"), row(2, "junk"), row(3, None)], [row(4, "2024-01-01 00:00:05"), row(5, "2024-01-01 00:00:20")], [row(6, "nonsense")]]
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, pl.LANDING_SCHEMA).write.parquet(f"{paths.landing}/drop={i}")
    pl.run_micro_batches(spark, paths, files_per_trigger=1)
    assert sorted(r.event_id for r in pl.read_sink(spark, paths).collect()) == [1, 5]
    assert sorted(map(tuple, pl.read_rejections(spark, paths).collect())) == [(0, 0, 2), (1, 1, 0), (2, 0, 1)]


def test_events_stream_reads_a_folder_of_files(spark):
    from contrail.sources.tables import table
    from contrail.streaming import pipeline as pl

    root = scratch_path(spark, "t-folder")
    events = table(spark, SF_SMALL, "events")
    events.repartition(5).write.parquet(f"{root}/events.parquet")
    pl.run_to_table(pl.typed_events(pl.to_landing(pl.stream_events(spark, root))), f"{root}/out", f"{root}/_ck")
    assert spark.read.parquet(f"{root}/out").count() == events.count()


def test_minor_compaction_skips_compact_partitions(spark):
    df = spark.range(0, 2000).select((F.col("id") % 2 + 1999).alias("year"), "id")
    t = tbl.VersionedTable.create(spark, df, scratch_path(spark, "t-minor"), ["year"], files_per_partition=5)
    t.compact(spark, where=F.col("year") == 2000)
    single = [f for f in t.read(spark).inputFiles() if "year=2000" in f]
    t.compact(spark, mode="minor", min_files=2)
    assert _files(spark, t) == {1999: 1, 2000: 1}
    assert set(single) <= set(t.read(spark).inputFiles())
    assert t.read(spark).count() == 2000


def test_write_audit_publish_refs(spark):
    docs = spark.createDataFrame([(1, 'a"b'), (2, "c")], "id long, text string")
    ok = qa.write_audit_publish(spark, docs, lambda d: d.withColumn("text", F.regexp_replace("text", '"', "")),
                                lambda c: qa.scan_tests(c, [qa.pattern_rule("text", '"', "quotes", 0, 0)]), "t-wap")
    assert sorted(r.text for r in ok.read(spark).collect()) == ["ab", "c"]
    assert [r.ref for r in ok.refs.listing(spark).collect()] == ["main"]   # branch dropped after publish
    with pytest.raises(qa.DataQualityError):                               # audit fails: nothing published
        qa.write_audit_publish(spark, docs, lambda d: d,
                               lambda c: qa.scan_tests(c, [qa.pattern_rule("text", '"', "quotes", 0, 0)]), "t-wap2")


def test_fact_reused_from_shared_dir(spark):
    from contrail.sources import tables as st

    shared = scratch_path(spark, "t-facts")
    spark.conf.set("contrail.fact.dir", shared)
    try:
        st._FACTS.clear()
        a = st.flights(spark, SF_SMALL)
        st._FACTS.clear()            # a later application: nothing cached in memory
        b = st.flights(spark, SF_SMALL)
        assert sorted(a.inputFiles()) == sorted(b.inputFiles())
        assert all(shared.split("/", 1)[-1] in f for f in b.inputFiles())
        assert b.count() == st.flights(spark, SF_SMALL, materialize=False).count()
    finally:
        spark.conf.unset("contrail.fact.dir")
        st._FACTS.clear()


def test_dashboards_agree_with_the_semantic_model(spark):
    """Aggregating before the joins gives what the row-by-row model gives."""
    from contrail.plans.analytics import dashboard_avg_delay_top25, dashboard_route_traffic, semantic_model

    m = semantic_model(spark, SF_SMALL)
    route = m.groupBy(F.concat_ws("-", "origin", "dest").alias("route")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("distance").alias("d"), F.countDistinct("uniquecarrier").alias("c"))
    assert sorted(map(tuple, route.collect())) == sorted(map(tuple, dashboard_route_traffic(spark, SF_SMALL).collect()))
    mean = {r.uniquecarrier: r.a for r in m.groupBy("uniquecarrier").agg(F.avg(F.coalesce("depdelay", F.lit(0))).alias("a")).collect()}
    got = dashboard_avg_delay_top25(spark, SF_SMALL).collect()
    assert got and all(abs(r.avg_dep_delay - mean[r.uniquecarrier]) < 1e-6 for r in got)


def test_prompt_reaches_the_scan(spark):
    from contrail.plans.analytics import dashboard_cancel_correlation

    plan = dashboard_cancel_correlation(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "In(cancellationcode" in plan.split("PushedFilters", 1)[1]


def test_changed_input_gets_a_new_shared_fact(spark):
    import shutil
    import tempfile
    from pathlib import Path

    from contrail.sources.tables import _fingerprint

    root = Path(tempfile.mkdtemp())
    for t in ("lineitem", "orders", "customer", "supplier"):
        shutil.copyfile(f"{SF_SMALL}/{t}.parquet", root / f"{t}.parquet")
    first = _fingerprint(spark, str(root))
    assert first == _fingerprint(spark, f"{root}/")
    shutil.copyfile("/root/testdata/sf0.01/orders.parquet", root / "orders.parquet")
    assert _fingerprint(spark, str(root)) != first


def test_watermark_drops_rows_later_than_it(spark):
    from contrail.plans.streams import SPLIT_TS
    from contrail.sources.tables import table
    from contrail.streaming import pipeline as pl

    events = table(spark, SF_SMALL, "events")
    root = scratch_path(spark, "t-wm")
    pl.write_landing_drops(spark, events, f"{root}/landing", SPLIT_TS, files_per_drop=1)
    # A third drop re-sends error events a day older than the first drop's end: by then both the
    # late-row watermark (previous batch) and the eviction watermark have passed them.
    stale = events.where((F.col("event_type") == "error") & (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")))
    pl.to_landing(stale).repartition(1).write.parquet(f"{root}/landing/drop=2")
    typed = pl.typed_events(pl.landing_stream(spark, f"{root}/landing", files_per_trigger=1))
    counts = typed.withWatermark("event_ts", "2 hours").groupBy(F.window("event_ts", "15 minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("count"))
    out = pl.run_updating_aggregate(counts, ["w"], f"{root}/updates", f"{root}/_ck")
    assert stale.count() > 0
    assert out.agg(F.sum("count")).first()[0] == events.count()   # stale copies dropped, nothing lost


def test_update_reads_and_writes_only_touched_partitions(spark):
    df = spark.range(0, 300).select((F.col("id") % 3 + 1999).alias("year"), F.col("id"), (F.col("id") % 5).alias("v"))
    t = tbl.VersionedTable.create(spark, df, scratch_path(spark, "t-touch"), ["year"])
    before = set(t.read(spark).inputFiles())
    t.update(spark, (F.col("year") == 2000) & (F.col("v") == 0), {"v": F.lit(42)})
    new = set(t.read(spark).inputFiles()) - before
    assert new and all("year=2000" in f for f in new)    # one write, of the touched partition alone
    assert t.read(spark).where("v = 42").count() == df.where("year = 2000 AND v = 0").count()
    assert t.read(spark).count() == 300


def test_merge_refuses_a_stage_that_repeats_a_key(spark):
    from contrail.operators import scd2

    dim = scd2.initial_load(spark.createDataFrame([(1, "a")], "code int, description string"), scd2.VARIANT_A, "2021-01-01", "2021-01-01")
    with pytest.raises(scd2.DuplicateKeyError):
        scd2.merge(dim, spark.createDataFrame([(1, "b"), (1, "c")], "code int, description string"), "2022-01-01")


def test_range_partitioned_write_splits_a_hot_partition(spark):
    # month 1 holds 60 % of the rows: it must be written by several tasks, not one
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 6, 1).otherwise(F.col("id") % 10).cast("int").alias("month"), "id")
    path = scratch_path(spark, "t-range")
    tbl.write_range_partitioned(df, path, ["month"], ["id"], writers=8)
    files = [f for f in spark.read.parquet(path).inputFiles() if "month=1/" in f]
    assert len(files) >= 3
    assert spark.read.parquet(path).count() == 20000
