"""Table evolution and maintenance queries: SCD2, snapshots, DML, rollups, compaction, sinks."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators import scd2
from contrail.operators import tables as tbl
from contrail.operators.aggregates import rollup_measures
from contrail.operators.joins import dim_join
from contrail.plans.registry import register
from contrail.session import scratch_path
from contrail.sources.tables import airlines, flights, table, with_views

# --------------------------------------------------------------------------- SCD2 fixture
# dim = airlines (from supplier); stage = the same list where nation 3 carriers get a new
# description, nation 7 carriers disappear, and one new carrier (-1, 'New Airline') arrives.

AS_OF_TS = "2024-04-11 12:06:15"
AS_OF_DATE = "2024-04-11"
LOADED_TS = "2021-01-01 00:00:00"
LOADED_DATE = "2021-01-01"


def scd_stage(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").where(F.col("s_nationkey") != 7)
    desc = F.when(F.col("s_nationkey") == 3, F.concat(F.lit("Update - "), F.upper("s_name"))).otherwise(F.col("s_name"))
    base = s.select(F.col("s_suppkey").cast("int").alias("code"), desc.alias("description"))
    new = spark.createDataFrame([(-1, "New Airline")], "code int, description string")
    return base.unionByName(new)


_STAGE_SQL = ("SELECT CAST(s_suppkey AS INT) AS code, CASE WHEN s_nationkey = 3 THEN 'Update - ' || upper(s_name) "
              "ELSE s_name END AS description FROM supplier WHERE s_nationkey <> 7 "
              "UNION ALL SELECT -1 AS code, 'New Airline' AS description")


def dim_a(spark, d):
    return scd2.initial_load(airlines(spark, d), scd2.VARIANT_A, LOADED_TS, LOADED_TS)


_DIM_A_SQL = (f"SELECT code, description, TIMESTAMP '{LOADED_TS}' AS updated_at, TIMESTAMP '{LOADED_TS}' AS valid_from, "
              "TIMESTAMP '9999-01-01 00:00:00' AS valid_to FROM airlines")
_SCD_VIEWS = {"stage": _STAGE_SQL, "dim": _DIM_A_SQL}


def _committed(spark, dim: DataFrame, *merges) -> DataFrame:
    """Store ``dim``, run the merges (stage, as_of, options) one after another on the stored table, and read it."""
    refs = tbl.TableRefs(scratch_path(spark, "dim-refs"))
    path = scratch_path(spark, "dim")
    dim.write.parquet(path)
    refs.set(spark, "main", path, LOADED_TS)
    for stage, as_of, opts in merges:
        scd2.merge_into("main", refs, stage, as_of, opts)
    return spark.read.schema(dim.schema).parquet(refs.resolve(spark, "main"))


@register("scd2_change_feed", with_views("""
SELECT 'update - change the old row' AS ops, s.code AS join_key, s.code, s.description
  FROM stage s JOIN dim d ON s.code = d.code WHERE s.description IS DISTINCT FROM d.description
UNION ALL SELECT 'update - insert row', NULL, s.code, s.description
  FROM stage s JOIN dim d ON s.code = d.code WHERE s.description IS DISTINCT FROM d.description
UNION ALL SELECT 'insert', NULL, s.code, s.description FROM stage s WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.code = s.code)
UNION ALL SELECT 'delete', d.code, d.code, d.description FROM dim d
  WHERE NOT EXISTS (SELECT 1 FROM stage s WHERE d.code = s.code)""", "airlines", extra=_SCD_VIEWS))
def scd2_change_feed(spark, d):
    return scd2.change_feed(dim_a(spark, d), scd_stage(spark, d), scd2.VARIANT_A)


def _merge_sql(dim_sql: str, ts: str, open_end: str, with_deletes: bool, with_updated: bool) -> str:
    upd = lambda v: f"{v} AS updated_at, " if with_updated else ""
    d_upd = "d.updated_at, " if with_updated else ""
    closed_where = "s.code IS NULL OR d.description IS DISTINCT FROM s.description" if with_deletes else \
        "s.code IS NOT NULL AND d.description IS DISTINCT FROM s.description"
    kept_where = "s.code IS NOT NULL AND d.description IS NOT DISTINCT FROM s.description" if with_deletes else \
        "s.code IS NULL OR d.description IS NOT DISTINCT FROM s.description"
    return f"""WITH airlines AS ({_AIRLINES}), stage AS ({_STAGE_SQL}), dim AS ({dim_sql})
SELECT d.code, d.description, {d_upd}d.valid_from, d.valid_to FROM dim d LEFT JOIN stage s ON d.code = s.code
  WHERE {kept_where}
UNION ALL SELECT d.code, d.description, {upd(ts)}d.valid_from, {ts} AS valid_to FROM dim d LEFT JOIN stage s
  ON d.code = s.code WHERE {closed_where}
UNION ALL SELECT s.code, s.description, {upd(ts)}{ts} AS valid_from, {open_end} AS valid_to FROM stage s
  LEFT JOIN dim d ON d.code = s.code WHERE d.code IS NULL OR d.description IS DISTINCT FROM s.description"""


_AIRLINES = "SELECT CAST(s_suppkey AS INT) AS code, s_name AS description FROM supplier"


@register("scd2_merge_a", _merge_sql(_DIM_A_SQL, f"TIMESTAMP '{AS_OF_TS}'", "TIMESTAMP '9999-01-01 00:00:00'", True, True))
def scd2_merge_a(spark, d):
    return _committed(spark, dim_a(spark, d), (scd_stage(spark, d), AS_OF_TS, scd2.VARIANT_A))


_DIM_B_SQL = (f"SELECT code, description, DATE '{LOADED_DATE}' AS updated_at, DATE '{LOADED_DATE}' AS valid_from, "
              "CAST(NULL AS DATE) AS valid_to FROM airlines")


@register("scd2_merge_b", _merge_sql(_DIM_B_SQL, f"DATE '{AS_OF_DATE}'", "CAST(NULL AS DATE)", False, True))
def scd2_merge_b(spark, d):
    dim = scd2.initial_load(airlines(spark, d), scd2.VARIANT_B, LOADED_DATE, LOADED_DATE)
    return _committed(spark, dim, (scd_stage(spark, d), AS_OF_DATE, scd2.VARIANT_B))


_DIM_C_SQL = (f"SELECT code, description, DATE '{LOADED_DATE}' AS valid_from, CAST(NULL AS DATE) AS valid_to "
              "FROM airlines WHERE code IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20)")


@register("scd2_merge_c", _merge_sql(_DIM_C_SQL, f"DATE '{AS_OF_DATE}'", "CAST(NULL AS DATE)", False, False))
def scd2_merge_c(spark, d):
    """Initial load holds only carriers of nations below 20, so the rest arrive as inserts."""
    loaded = table(spark, d, "supplier").where(F.col("s_nationkey") < 20).select(
        F.col("s_suppkey").cast("int").alias("code"), F.col("s_name").alias("description"))
    dim = scd2.initial_load(loaded, scd2.VARIANT_C, LOADED_DATE, LOADED_DATE)
    return _committed(spark, dim, (scd_stage(spark, d), AS_OF_DATE, scd2.VARIANT_C))


# A second snapshot: nation 3 has its old names back, nation 7 returns, nation 5 disappears.
LATER_TS = "2024-05-02 08:00:00"


@register("scd2_merge_twice", f"""
WITH s AS (SELECT CAST(s_suppkey AS INT) AS code, s_name, s_nationkey AS n FROM supplier),
t(load, first, second, open) AS (VALUES (TIMESTAMP '{LOADED_TS}', TIMESTAMP '{AS_OF_TS}', TIMESTAMP '{LATER_TS}', TIMESTAMP '9999-01-01 00:00:00')),
v AS (
  SELECT code, s_name AS description, load AS updated_at, load AS valid_from, open AS valid_to FROM s, t WHERE n NOT IN (3, 5, 7)
  UNION ALL SELECT code, s_name, first, load, first FROM s, t WHERE n IN (3, 7)
  UNION ALL SELECT code, 'Update - ' || upper(s_name), second, first, second FROM s, t WHERE n = 3
  UNION ALL SELECT code, s_name, second, second, open FROM s, t WHERE n IN (3, 7)
  UNION ALL SELECT code, s_name, second, load, second FROM s, t WHERE n = 5
  UNION ALL SELECT -1, 'New Airline', second, first, second FROM t)
SELECT * FROM v""")
def scd2_merge_twice(spark, d):
    """Two merges on the stored dimension: versions closed by the first stay as they are in the second."""
    later = table(spark, d, "supplier").where(F.col("s_nationkey") != 5).select(
        F.col("s_suppkey").cast("int").alias("code"), F.col("s_name").alias("description"))
    return _committed(spark, dim_a(spark, d), (scd_stage(spark, d), AS_OF_TS, scd2.VARIANT_A), (later, LATER_TS, scd2.VARIANT_A))


@register("join_semi_changed", with_views("""
SELECT s.code, s.description FROM stage s
WHERE EXISTS (SELECT 1 FROM dim d WHERE s.code = d.code AND s.description <> d.description)""", "airlines",
                                      extra=_SCD_VIEWS))
def join_semi_changed(spark, d):
    s, t = scd_stage(spark, d).alias("s"), dim_a(spark, d).alias("t")
    cond = (F.col("s.code") == F.col("t.code")) & (F.col("s.description") != F.col("t.description"))
    return s.join(t, cond, "left_semi").select("code", "description")


@register("join_anti_new_deleted", with_views("""
SELECT 'insert' AS ops, s.code, s.description FROM stage s WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.code = s.code)
UNION ALL
SELECT 'delete', d.code, d.description FROM dim d WHERE NOT EXISTS (SELECT 1 FROM stage s WHERE d.code = s.code)""",
                                          "airlines", extra=_SCD_VIEWS))
def join_anti_new_deleted(spark, d):
    s, t = scd_stage(spark, d), dim_a(spark, d).select("code", "description")
    new = s.join(t.select("code"), "code", "left_anti").select(F.lit("insert").alias("ops"), "code", "description")
    gone = t.join(s.select("code"), "code", "left_anti").select(F.lit("delete").alias("ops"), "code", "description")
    return new.unionByName(gone)


# --------------------------------------------------------------------------- snapshots

SNAP_TIMES = ("2024-01-01 10:00:00", "2024-01-02 10:00:00")


def _snapshot_table(spark, d) -> tbl.SnapshotTable:
    f = flights(spark, d)
    st = tbl.SnapshotTable(scratch_path(spark, "flights-snapshots"))
    st.append(spark, f.where(F.col("year") <= 1998), SNAP_TIMES[0])
    st.append(spark, f.where(F.col("year") > 1998), SNAP_TIMES[1])
    return st


@register("snapshot_append_history", with_views(f"""
SELECT CAST(1 AS BIGINT) AS snapshot_id, CAST(NULL AS BIGINT) AS parent_id,
       TIMESTAMP '{SNAP_TIMES[0]}' AS committed_at, 'append' AS operation,
       count(*) FILTER (WHERE year <= 1998) AS rows_added, count(*) FILTER (WHERE year <= 1998) AS total_rows,
       true AS is_current_ancestor FROM flights
UNION ALL
SELECT 2, 1, TIMESTAMP '{SNAP_TIMES[1]}', 'append', count(*) FILTER (WHERE year > 1998), count(*), true
FROM flights""", "flights"))
def snapshot_append_history(spark, d):
    return _snapshot_table(spark, d).history(spark)


@register("snapshot_time_travel", with_views("""
SELECT 'version_1' AS read_kind, year, count(*) AS n_rows FROM flights WHERE year <= 1998 GROUP BY year
UNION ALL SELECT 'as_of_time', year, count(*) FROM flights WHERE year <= 1998 GROUP BY year
UNION ALL SELECT 'latest', year, count(*) FROM flights GROUP BY year""", "flights"))
def snapshot_time_travel(spark, d):
    st = _snapshot_table(spark, d)

    def counts(df: DataFrame, kind: str) -> DataFrame:
        return df.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(kind).alias("read_kind"), "year", "n_rows")

    return (counts(st.read(spark, version=1), "version_1")
            .unionByName(counts(st.read(spark, as_of="2024-01-01 12:00:00"), "as_of_time"))
            .unionByName(counts(st.read(spark), "latest")))


def writers_for(df: DataFrame) -> int:
    """As many writers as the input has splits, the shuffle width at least."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())


@register("partition_evolution", with_views("""
SELECT CASE WHEN year <= 1998 THEN 'by_year' ELSE 'by_year_month_day' END AS layout, year, month,
       count(*) AS n_rows FROM flights GROUP BY 1, 2, 3""", "flights"))
def partition_evolution(spark, d):
    """Older data keeps the coarse (year) layout, newer data uses (year, month, dayofmonth); reads union both."""
    f = flights(spark, d)
    old, new = scratch_path(spark, "flights-by-year"), scratch_path(spark, "flights-by-day")
    writers = writers_for(f)
    salt = ["tailnum", "flightnum", "deptime", "distance"]
    tbl.write_partitioned(f.where(F.col("year") <= 1998), old, ["year"])  # a scan task has rows of a few years at most
    tbl.write_range_partitioned(f.where(F.col("year") > 1998), new, ["year", "month", "dayofmonth"], salt, writers)
    both = (spark.read.parquet(old).withColumn("layout", F.lit("by_year"))
            .unionByName(spark.read.parquet(new).withColumn("layout", F.lit("by_year_month_day"))))
    return both.groupBy("layout", "year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


# --------------------------------------------------------------------------- DML


def _flights_table(spark, d, name: str, files_per_partition: int | None = None) -> tbl.VersionedTable:
    return tbl.VersionedTable.create(spark, flights(spark, d), scratch_path(spark, name), ["year"], files_per_partition)


@register("dml_update", with_views("""
SELECT year, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_negative,
  CAST(sum(CASE WHEN depdelay < 0 THEN 0 ELSE depdelay END) AS BIGINT) AS sum_depdelay,
  CAST(sum(CASE WHEN depdelay < 0 THEN arrdelay - depdelay ELSE arrdelay END) AS BIGINT) AS sum_arrdelay
FROM flights GROUP BY year""", "flights"))
def dml_update(spark, d):
    """UPDATE flights SET depdelay = 0, arrdelay = arrdelay - depdelay WHERE depdelay < 0."""
    t = _flights_table(spark, d, "flights-update")
    t.update(spark, F.col("depdelay") < 0, {"depdelay": F.lit(0), "arrdelay": F.col("arrdelay") - F.col("depdelay")})
    return t.read(spark).groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("depdelay") < 0, 1)).alias("n_negative"),
        F.sum("depdelay").alias("sum_depdelay"), F.sum("arrdelay").alias("sum_arrdelay"))


@register("dml_delete", with_views("""
SELECT year, count(*) AS n_rows, count(cancellationcode) AS n_with_code, CAST(sum(distance) AS BIGINT) AS sum_distance
FROM flights WHERE NOT coalesce(cancellationcode = 'F', false) GROUP BY year""", "flights"))
def dml_delete(spark, d):
    """DELETE FROM flights WHERE cancellationcode = 'F' (rows with a NULL code stay)."""
    t = _flights_table(spark, d, "flights-delete")
    t.delete(spark, F.col("cancellationcode") == "F")
    return t.read(spark).groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.count("cancellationcode").alias("n_with_code"),
                                 F.sum("distance").alias("sum_distance"))


# --------------------------------------------------------------------------- rollups


def build_rollup(f: DataFrame, al: DataFrame) -> DataFrame:
    """Rollup by airline code, name and month.

    Measures are first aggregated on (carrier, month) over the fact, then
    joined to the airlines and re-summed: the join handles one row per
    carrier-month instead of one per flight, with the same result.
    """
    pre = f.groupBy("uniquecarrier", "month").agg(*rollup_measures())
    j = dim_join(pre, al, F.col("uniquecarrier") == F.col("code"))
    return j.groupBy("code", F.col("description").alias("airline_name"), "month").agg(
        F.sum("flights_count").alias("flights_count"), F.sum("cancelled").alias("cancelled"),
        F.sum("departure_delay_minutes").alias("departure_delay_minutes"),
        F.sum("departure_delay_count").alias("departure_delay_count"))


_ROLLUP_KEYS = ["code", "airline_name", "month"]


def refresh_rollup(rollup: DataFrame, delta: DataFrame) -> DataFrame:
    """Fold a delta rollup into an existing one; equals a rebuild over base + delta."""
    return rollup.unionByName(delta).groupBy(*_ROLLUP_KEYS).agg(
        F.sum("flights_count").alias("flights_count"), F.sum("cancelled").alias("cancelled"),
        F.sum("departure_delay_minutes").alias("departure_delay_minutes"),
        F.sum("departure_delay_count").alias("departure_delay_count"))


def signed_rollup(changes: DataFrame, al: DataFrame) -> DataFrame:
    """Rollup of signed rows (``weight`` -1 or +1), the change that they make to a stored rollup.

    Rows that a rewrite copied unchanged cancel in the first, partial aggregate;
    groups that keep nothing go before the dimension is joined.
    """
    w, delay = F.col("weight"), F.coalesce("depdelay", F.lit(0))
    pre = changes.groupBy("uniquecarrier", "month").agg(
        F.sum(w).alias("flights_count"), F.sum(w * F.col("cancelled")).alias("cancelled"), F.sum(w * delay).alias("departure_delay_minutes"),
        F.sum(F.when(delay > 0, w).otherwise(0)).alias("departure_delay_count"))
    moved = pre.where("flights_count <> 0 or cancelled <> 0 or departure_delay_minutes <> 0 or departure_delay_count <> 0")
    j = dim_join(moved, al, F.col("uniquecarrier") == F.col("code"))
    return j.groupBy("code", F.col("description").alias("airline_name"), "month").agg(
        *[F.sum(c).alias(c) for c in ("flights_count", "cancelled", "departure_delay_minutes", "departure_delay_count")])


def apply_changes(rollup: DataFrame, signed: DataFrame) -> DataFrame:
    """A stored rollup after signed changes: groups without rows go, a count of no delayed flight is NULL as in a rebuild."""
    out = refresh_rollup(rollup, signed).where("flights_count <> 0")
    return out.withColumn("departure_delay_count", F.nullif("departure_delay_count", F.lit(0)))


@dataclass
class MaintainedRollup:
    """A stored rollup of a versioned table and the table version that it answers for."""
    base: tbl.VersionedTable
    path: str
    version: int

    @classmethod
    def build(cls, spark: SparkSession, base: tbl.VersionedTable, al: DataFrame) -> MaintainedRollup:
        version, path = base.version(spark), scratch_path(spark, "rollup-stored")
        build_rollup(base.read(spark, version), al).write.parquet(path)
        return cls(base, path, version)

    def refresh(self, spark: SparkSession, al: DataFrame) -> MaintainedRollup:
        """Fold in what happened to the table since: only folders that came or went are read, never the others."""
        until = self.base.version(spark)
        if until == self.version:
            return self
        signed = signed_rollup(self.base.changes(spark, self.version, until), al)
        path = scratch_path(spark, "rollup-stored")  # the rollup of the earlier version stays readable
        apply_changes(spark.read.parquet(self.path), signed).write.parquet(path)
        return MaintainedRollup(self.base, path, until)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


_ROLLUP_SQL = with_views("""
SELECT a.code, a.description AS airline_name, f.month, count(*) AS flights_count,
       CAST(sum(f.cancelled) AS BIGINT) AS cancelled,
       CAST(sum(coalesce(depdelay, 0)) AS BIGINT) AS departure_delay_minutes,
       CAST(sum(CASE WHEN coalesce(depdelay, 0) > 0 THEN 1 END) AS BIGINT) AS departure_delay_count
FROM flights f JOIN airlines a ON f.uniquecarrier = a.code GROUP BY a.code, a.description, f.month""",
                         "flights", "airlines")


@register("mv_rollup_build", _ROLLUP_SQL)
def mv_rollup_build(spark, d):
    path = scratch_path(spark, "rollup")
    build_rollup(flights(spark, d), airlines(spark, d)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@register("mv_incremental_refresh", _ROLLUP_SQL)
def mv_incremental_refresh(spark, d):
    """Rollup of year < 2001, then the year >= 2001 rows folded in; must equal ``mv_rollup_build``."""
    f, al = flights(spark, d), airlines(spark, d)
    path = scratch_path(spark, "rollup-incr")
    build_rollup(f.where(F.col("year") < 2001), al).write.mode("overwrite").parquet(path)
    delta = build_rollup(f.where(F.col("year") >= 2001), al)
    out = scratch_path(spark, "rollup-incr-v2")  # new version folder; the old one stays readable
    refresh_rollup(spark.read.parquet(path), delta).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


_DML_NOW = """
, base AS (
  SELECT uniquecarrier, month, cancelled, CASE WHEN depdelay < 0 THEN 0 ELSE depdelay END AS depdelay FROM flights
  WHERE NOT coalesce(cancellationcode = 'F' AND month IN (1, 2), false) AND NOT (uniquecarrier = 3 AND month = 5)),
now AS (
  SELECT * FROM base UNION ALL
  SELECT uniquecarrier, month, cancelled, depdelay + 60 FROM flights WHERE year = 1997 AND dayofmonth <= 3)
SELECT a.code, a.description AS airline_name, f.month, count(*) AS flights_count, CAST(sum(f.cancelled) AS BIGINT) AS cancelled,
       CAST(sum(coalesce(depdelay, 0)) AS BIGINT) AS departure_delay_minutes,
       CAST(sum(CASE WHEN coalesce(depdelay, 0) > 0 THEN 1 END) AS BIGINT) AS departure_delay_count
FROM now f JOIN airlines a ON f.uniquecarrier = a.code GROUP BY a.code, a.description, f.month"""


@register("mv_refresh_after_dml", with_views(_DML_NOW, "flights", "airlines"))
def mv_refresh_after_dml(spark, d):
    """A stored rollup kept right through UPDATE, DELETE and INSERT by signed deltas; must equal a rebuild."""
    f, al = flights(spark, d), airlines(spark, d)
    t = tbl.VersionedTable.create(spark, f, scratch_path(spark, "flights-maintained"), ["year"])
    rollup = MaintainedRollup.build(spark, t, al)
    t.update(spark, F.col("depdelay") < 0, {"depdelay": F.lit(0)})
    rollup = rollup.refresh(spark, al)
    t.delete(spark, (F.col("cancellationcode") == "F") & F.col("month").isin(1, 2))
    t.delete(spark, (F.col("uniquecarrier") == 3) & (F.col("month") == 5))  # whole groups go
    t.insert(spark, f.where("year = 1997 and dayofmonth <= 3").withColumn("depdelay", F.col("depdelay") + 60))
    return rollup.refresh(spark, al).read(spark)


@register("mv_answer_from_rollup", with_views("""
SELECT a.code, min(a.description) AS airline_name, count(*) AS flights_count,
       CAST(sum(f.cancelled) AS BIGINT) AS cancelled
FROM flights f JOIN airlines a ON f.uniquecarrier = a.code GROUP BY a.code""", "flights", "airlines"))
def mv_answer_from_rollup(spark, d):
    """Coarser grouping answered from the stored rollup; the fact is read only to build it."""
    r = mv_rollup_build(spark, d)
    return r.groupBy("code").agg(F.min("airline_name").alias("airline_name"),
                                 F.sum("flights_count").alias("flights_count"), F.sum("cancelled").alias("cancelled"))


# --------------------------------------------------------------------------- layout, compaction, sinks


COMPACT_ROWS = 5_000_000


@register("compact_partitions", with_views(f"""
SELECT year, count(*) AS rows, CAST(ceil(count(*) / {COMPACT_ROWS}.0) AS BIGINT) AS files,
       ceil(count(*) / {COMPACT_ROWS}.0) < 4 AS compacted FROM flights GROUP BY year""", "flights"))
def compact_partitions(spark, d):
    """Four files a year merged into one for every five million rows."""
    t = _flights_table(spark, d, "flights-small-files", files_per_partition=4)
    before = [tuple(r) for r in t.layout(spark).select("year", "files").collect()]  # one row per partition
    t.compact(spark, target_rows_per_file=COMPACT_ROWS)
    frozen = spark.createDataFrame(before, "year int, files_before long")
    return t.layout(spark).join(F.broadcast(frozen), "year").select("year", "rows", "files", (F.col("files") < F.col("files_before")).alias("compacted"))


@register("compact_small_files", with_views("""
SELECT year, count(*) + count(*) FILTER (WHERE dayofmonth <= 3) AS rows, CAST(4 AS BIGINT) AS files_before, CAST(3 AS BIGINT) AS files_read,
       CAST(2 AS BIGINT) AS files_after, true AS large_untouched FROM flights GROUP BY year""", "flights"))
def compact_small_files(spark, d):
    """One large file a year and three small inserts; packing reads the small files only and leaves the large one."""
    f = flights(spark, d)
    t = tbl.VersionedTable.create(spark, f, scratch_path(spark, "flights-inserts"), ["year"], files_per_partition=1)
    large = t.file_sizes(spark).select(F.col("year").alias("_y"), F.col("file").alias("_large"), F.col("bytes").alias("_bytes")).collect()
    for day in (1, 2, 3):
        t.insert(spark, f.where(F.col("dayofmonth") == day), files_per_partition=1)
    before = [tuple(r) for r in t.layout(spark).select("year", "files").collect()]  # one row per partition
    read = t.compact_small_files(spark, target_bytes=max(r["_bytes"] for r in large)).groupBy("year").agg(F.count(F.lit(1)).alias("files_read"))
    now = t.file_sizes(spark).groupBy("year").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files_after"), F.collect_set("file").alias("_files"))
    was = spark.createDataFrame(before, "year int, files_before long")
    kept = spark.createDataFrame(large, "_y int, _large string, _bytes long")  # the frames joined here have one row per partition
    out = now.join(F.broadcast(was), "year").join(F.broadcast(read), "year").join(F.broadcast(kept), F.col("year") == F.col("_y"))
    return out.select("year", "rows", "files_before", "files_read", "files_after", F.array_contains("_files", F.col("_large")).alias("large_untouched"))


@register("table_layout_profile", with_views("""
SELECT year, CAST(2 AS BIGINT) AS files, count(*) AS rows FROM flights GROUP BY year""", "flights"))
def table_layout_profile(spark, d):
    return _flights_table(spark, d, "flights-layout", files_per_partition=2).layout(spark)


@register("sink_ctas_roundtrip", with_views("""
SELECT count(*) AS n_rows, CAST(sum(distance) AS BIGINT) AS total_distance, count(DISTINCT tailnum) AS n_tailnums
FROM flights""", "flights"))
def sink_ctas_roundtrip(spark, d):
    """CREATE TABLE AS SELECT into Parquet, then verify the re-read row count against the source."""
    src = flights(spark, d)
    path = scratch_path(spark, "flights-ctas")
    src.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    written = back.count()
    expected = src.count()
    if written != expected:
        raise RuntimeError(f"CTAS wrote {written} rows, source has {expected}")
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("distance").alias("total_distance"),
                    F.countDistinct("tailnum").alias("n_tailnums"))


@register("sink_partitioned_roundtrip", with_views("""
SELECT year, month, count(*) AS n_rows, CAST(sum(distance) AS BIGINT) AS total_distance
FROM flights GROUP BY year, month""", "flights"))
def sink_partitioned_roundtrip(spark, d):
    path = scratch_path(spark, "flights-by-month")
    tbl.write_range_partitioned(flights(spark, d), path, ["year", "month"], ["tailnum", "flightnum", "deptime", "distance"],
                                writers_for(flights(spark, d)))
    return spark.read.parquet(path).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("distance").alias("total_distance"))


@register("scan_partition_pruned", with_views("""
SELECT year, month, count(*) AS n_rows FROM flights
WHERE (year, month) = (SELECT (year, month) FROM flights ORDER BY year DESC, month DESC LIMIT 1)
GROUP BY year, month""", "flights"))
def scan_partition_pruned(spark, d):
    """Count one month of the (year, month)-partitioned fact; the filter prunes to one folder."""
    t = flights(spark, d)
    y, m = newest_partition(t)
    return t.where((F.col("year") == y) & (F.col("month") == m)).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_rows"))


def newest_partition(t: DataFrame) -> tuple[int, int]:
    """Highest (year, month), taken from the folder names of the listing that the scan needs anyway: no job."""
    named = (re.search(r"/year=(-?\d+)/month=(\d+)/", f) for f in t.inputFiles())
    return max((int(m[1]), int(m[2])) for m in named if m)


@register("scan_pruned_by_dim", with_views("""
, calendar AS (SELECT DISTINCT year, month, CAST(ceil(month / 3.0) AS INTEGER) AS quarter, year % 2 = 1 AS odd_year FROM flights)
SELECT f.year, f.month, c.quarter, count(*) AS n_rows, CAST(sum(f.distance) AS BIGINT) AS total_distance
FROM flights f JOIN calendar c ON f.year = c.year AND f.month = c.month WHERE c.quarter = 2 AND c.odd_year GROUP BY ALL""", "flights"))
def scan_pruned_by_dim(spark, d):
    """The second quarters of odd years: the filter on the calendar prunes the fact's folders while the join runs."""
    return quarters(flights(spark, d), calendar(spark, d), (F.col("quarter") == 2) & F.col("odd_year"))


def calendar(spark: SparkSession, d: str) -> DataFrame:
    """One row per month of the fact, stored as a dimension; at most twelve rows a year."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _CALENDARS:
        path = scratch_path(spark, "calendar")
        months = flights(spark, d).select("year", "month").distinct()
        months.withColumns({"quarter": F.ceil(F.col("month") / 3).cast("int"), "odd_year": F.col("year") % 2 == 1}).coalesce(1).write.parquet(path)
        _CALENDARS[key] = path
    return spark.read.parquet(_CALENDARS[key])


_CALENDARS: dict[tuple[str, str], str] = {}


def quarters(f: DataFrame, cal: DataFrame, chosen: Column) -> DataFrame:
    """Rows and distance by month of the chosen months; the calendar side is a broadcast that also prunes the scan."""
    j = f.join(F.broadcast(cal.where(chosen)), ["year", "month"])
    return j.groupBy("year", "month", "quarter").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("distance").alias("total_distance"))
