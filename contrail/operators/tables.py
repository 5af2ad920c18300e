"""Table maintenance on plain Parquet folders.

No table format is assumed.  Conventions used here:

* A :class:`VersionedTable` is a list of partition folders.  UPDATE, DELETE and
  compaction read only the folders they touch, write their new rows once, and
  become visible with one log row in which the new folders stand for the old, so a
  lost job or a concurrent reader never sees half a rewrite.
* A *snapshot table* keeps each append in a folder of its own under ``data/`` and a
  commit log under ``log/`` that names the folder.  A snapshot exists once its log
  row is written, so a job lost between the two writes leaves nothing visible.
* Log entry N is a file named N that is created only if it is absent, so of two
  writers one comes second and builds its entry anew (:func:`commit`).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.session import path_exists, read_or_none, session_conf


def in_partitions(parts: list[tuple], partition_by: list[str], schema: T.StructType) -> Column:
    """Null-safe literal predicate that selects exactly the listed partitions (becomes a scan PartitionFilter)."""
    lit = lambda c, v: F.lit(v).cast(schema[c].dataType)
    if len(partition_by) == 1:
        c = partition_by[0]
        known = F.coalesce(F.col(c).isin([lit(c, p[0]) for p in parts if p[0] is not None]), F.lit(False))
        return known | F.col(c).isNull() if any(p[0] is None for p in parts) else known
    each = [reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(lit(c, v)) for c, v in zip(partition_by, p)]) for p in parts]
    return reduce(lambda x, y: x | y, each, F.lit(False))


def _planned(df: DataFrame, partition_by: list[str], rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """``df`` with the numbers ``names`` of each row's partition; ``rows`` holds one tuple per partition."""
    fields = [T.StructField(f"_p{i}", df.schema[c].dataType) for i, c in enumerate(partition_by)] + [T.StructField(n, T.LongType()) for n in names]
    plan = F.broadcast(df.sparkSession.createDataFrame(rows, T.StructType(fields)))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(partition_by)])
    return df.join(plan, same, "left").drop(*[f"_p{i}" for i in range(len(partition_by))])


def write_exact(df: DataFrame, path: str, partition_by: list[str], files: Column, sort_by: list[str] | None = None) -> None:
    """Partitioned write with a set number of files for each partition, whatever the session's shuffle width.

    ``files`` is an aggregate over a partition's rows.  Each (partition, file) pair gets a writer task of
    its own, to which its rows are sent by number.
    """
    sizes = df.groupBy(*partition_by).agg(files.cast("int").alias("_k")).collect()  # one row per partition
    rows, base = [], 0
    for r in sorted(sizes, key=str):
        rows.append((*[r[c] for c in partition_by], base, r["_k"]))
        base += r["_k"]
    writer = (F.col("_base") + F.pmod(F.xxhash64(*df.columns), F.col("_files"))).cast("int")
    dealt = _planned(df, partition_by, rows, ("_base", "_files")).withColumn("_w", writer).repartitionById(max(1, base), "_w").select(*df.columns)
    if sort_by:
        dealt = dealt.sortWithinPartitions(*partition_by, *sort_by)
    dealt.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


SINGLE_WRITERS = 64  # partitions that write_single_files plans at most


def stored_by(df: DataFrame, partition_by: list[str]) -> bool:
    """Whether ``df`` is read from folders of these columns, so a filter on them reads their files only."""
    files = df.inputFiles()
    return bool(files) and all(f"/{c}=" in f for f in files for c in partition_by)


def write_single_files(df: DataFrame, path: str, partition_by: list[str], parts: list[tuple]) -> None:
    """One file for each of the partitions ``parts``, by a task that reads that partition's own files; nothing is shuffled."""
    each = [df.where(in_partitions([p], partition_by, df.schema)).coalesce(1) for p in parts]
    with session_conf(df.sparkSession, "spark.sql.unionOutputPartitioning", "false"):  # or the single partitions become one
        reduce(DataFrame.union, each).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], files_per_partition: int | None = None) -> None:
    """Write ``df`` partitioned by ``partition_by``.

    ``files_per_partition=None`` lets each task write its share (fast, more
    files); an integer routes each partition's rows to that many writers.
    """
    if files_per_partition:
        write_exact(df, path, partition_by, F.lit(files_per_partition))
    else:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_range_partitioned(df: DataFrame, path: str, partition_by: list[str], salt_cols: list[str],
                            writers: int, counted: DataFrame | None = None,
                            finish: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Partitioned write with ``writers`` range-partitioned tasks on (partition columns, row hash).

    Each task holds a narrow band of partition values, so files per partition
    stay few; the hash of ``salt_cols`` splits one hot partition value over
    several tasks instead of sending it all to one.  The bands come from the
    rows of each partition in ``counted`` (``df`` unless a cheaper frame has about the
    same ones), so ``df`` is not run a second time for a sample.  ``finish`` makes
    the written columns of rows that have arrived at their writer.
    """
    # One row per partition.
    sizes = (df if counted is None else counted).groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_n")).collect()
    rows, start = [], 0
    for r in sorted(sizes, key=lambda r: [(r[c] is not None, r[c]) for c in partition_by]):
        rows.append((*[r[c] for c in partition_by], start, r["_n"]))
        start += r["_n"]
    within = F.pmod(F.xxhash64(*salt_cols), F.lit(1 << 20)) / (1 << 20)
    writer = ((F.col("_start") + within * F.col("_rows")) / F.lit(max(1, start) / writers)).cast("int")
    planned = _planned(df, partition_by, rows, ("_start", "_rows")).withColumn("_w", F.coalesce(F.least(writer, F.lit(writers - 1)), F.lit(0)))
    dealt = planned.repartitionById(writers, "_w").select(*df.columns)
    finish(dealt).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


class CommitConflict(RuntimeError):
    """Another writer changed what this commit was computed from."""


def publish(spark: SparkSession, row: DataFrame, target: str) -> bool:
    """Put the one-row frame at the file ``target`` unless that exists already; False when it does.

    The row is written elsewhere and renamed, so a reader sees the whole file or none.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    folder = target.rsplit("/", 1)[0]
    attempt = f"{folder}-attempts/{uuid.uuid4().hex}"
    row.coalesce(1).write.parquet(attempt)
    fs = path(folder).getFileSystem(conf)
    fs.mkdirs(path(folder))
    part = next(f.getPath() for f in fs.listStatus(path(attempt)) if f.getPath().getName().endswith(".parquet"))
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(target).toUri(), conf)
    never_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(part, path(target), never_overwrite)
    except Py4JJavaError:
        if not path_exists(spark, target):
            raise
        return False
    finally:
        fs.delete(path(attempt), True)
    return True


def commit(spark: SparkSession, log_path: str, schema: str, build) -> int:
    """Append one row to a log and return its number.

    ``build(log)`` gives (number, row) for the log as it is now.  Entry N is a file of that
    name; the writer that comes second finds it there, reads the log again and builds anew.
    """
    while True:
        number, row = build(read_or_none(spark, log_path, schema))
        if publish(spark, row, f"{log_path}/{number:012d}.parquet"):
            return number


def _row(spark: SparkSession, schema: str, *values) -> DataFrame:
    return spark.createDataFrame([values], schema)


_VERSIONS = "seq long, folders array<string>, schema string, op string"


@dataclass
class VersionedTable:
    """A partitioned Parquet table whose versions name the partition folders that hold it.

    Every write goes to ``data/_write=<id>/<partition>/``.  A version is the list
    of such partition folders; a rewrite replaces the names of the folders it read.
    A folder of which only some files were compacted is listed by the files that stay.
    """
    root: str
    partition_by: list[str]

    @classmethod
    def create(cls, spark: SparkSession, df: DataFrame, root: str, partition_by: list[str],
               files_per_partition: int | None = None) -> VersionedTable:
        t = cls(root, partition_by)
        path = t._new_folder()
        parts = []
        if files_per_partition == 1 and stored_by(df, partition_by):
            parts = [tuple(r) for r in df.select(*partition_by).distinct().collect()]  # one row per partition
        if 0 < len(parts) <= SINGLE_WRITERS:
            write_single_files(df, path, partition_by, parts)
        else:
            write_partitioned(df, path, partition_by, files_per_partition)
        # Spark reads partition columns back behind the others.
        fields = [f for f in df.schema.fields if f.name not in partition_by] + [df.schema[c] for c in partition_by]
        schema, folders = T.StructType(fields), t._folders_under(spark, path)

        def build(log):
            if log is not None:
                raise CommitConflict(f"{root} holds a table already")
            return 0, _row(spark, _VERSIONS, 0, folders, schema.json(), "create")

        commit(spark, t.log_path, _VERSIONS, build)
        return t

    @property
    def data_path(self) -> str:
        return f"{self.root}/data"

    @property
    def log_path(self) -> str:
        return f"{self.root}/versions"

    def _new_folder(self) -> str:
        return f"{self.data_path}/_write={uuid.uuid4().hex[:12]}"

    def _folders_under(self, spark: SparkSession, path: str) -> list[str]:
        """Partition folders of one write, relative to the data folder."""
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path + "/*" * len(self.partition_by))
        found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
        names = ["/".join(str(f.getPath().toString()).rsplit("/", len(self.partition_by) + 1)[1:]) for f in found or [] if f.isDirectory()]
        return sorted(names)

    def _state(self, spark: SparkSession, version: int | None = None) -> tuple[int, list[str], T.StructType]:
        log = spark.read.schema(_VERSIONS).parquet(self.log_path)
        log = log if version is None else log.where(F.col("seq") <= version)
        row = log.orderBy(F.desc("seq")).first()
        return row["seq"], list(row["folders"]), T.StructType.fromJson(json.loads(row["schema"]))

    def _read_folders(self, spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField("_write", T.StringType())])
        paths = [f"{self.data_path}/{f}" for f in folders]
        return spark.read.schema(full).option("basePath", self.data_path).parquet(*paths)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The rows of the latest (or an earlier) version."""
        _, folders, schema = self._state(spark, version)
        return self._read_folders(spark, folders, schema).select(*schema.names)

    def version(self, spark: SparkSession) -> int:
        return self._state(spark)[0]

    def _replace(self, spark: SparkSession, read: list[str], path: str, op: str, stay: list[str] = ()) -> None:
        """The folders of ``path``, and the files that ``stay``, stand for the entries that were ``read``."""
        new = [*self._folders_under(spark, path), *stay]

        def build(_log):
            seq, folders, schema = self._state(spark)
            if not set(read) <= set(folders):
                raise CommitConflict(f"{op} read folders that another writer has replaced since")
            left = sorted((set(folders) - set(read)) | set(new))
            return seq + 1, _row(spark, _VERSIONS, seq + 1, left, schema.json(), op)

        commit(spark, self.log_path, _VERSIONS, build)

    def _where(self, spark: SparkSession, cond: Column, folders: list[str], schema: T.StructType) -> list[str]:
        """Entries that hold at least one row matching ``cond`` (one row per file reaches the driver)."""
        if not folders:
            return []
        files = self._read_folders(spark, folders, schema).where(cond).select(F.col("_metadata.file_path").alias("f")).distinct()
        known = set(folders)
        return sorted({self._entry(r["f"], known) for r in files.collect()})

    def _entry(self, uri: str, known: set[str]) -> str:
        """The entry of a version that a file belongs to: its folder, or the file itself."""
        file = "/".join(unquote(uri).rsplit("/", len(self.partition_by) + 2)[1:])
        folder = file.rsplit("/", 1)[0]
        return folder if folder in known else file

    def insert(self, spark: SparkSession, rows: DataFrame, files_per_partition: int | None = None) -> None:
        """``INSERT INTO t``: the rows get folders of their own."""
        _, _, schema = self._state(spark)
        path = self._new_folder()
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        write_partitioned(typed, path, self.partition_by, files_per_partition)
        self._replace(spark, [], path, "insert")

    def update(self, spark: SparkSession, cond: Column, assignments: dict[str, Column]) -> None:
        """``UPDATE t SET col = expr, ... WHERE cond``, also of partition columns; reads only folders with a match."""
        _, folders, schema = self._state(spark)
        read = self._where(spark, cond, folders, schema)
        if not read:
            return
        src, hit = self._read_folders(spark, read, schema), F.coalesce(cond, F.lit(False))
        new = src.select(*[F.when(hit, assignments[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f.name in assignments
                           else F.col(f.name) for f in schema.fields])
        path = self._new_folder()
        write_partitioned(new, path, self.partition_by)
        self._replace(spark, read, path, "update")

    def delete(self, spark: SparkSession, cond: Column) -> None:
        """``DELETE FROM t WHERE cond``: rows whose condition is NULL are kept, like SQL."""
        _, folders, schema = self._state(spark)
        read = self._where(spark, cond, folders, schema)
        if not read:
            return
        path = self._new_folder()
        left = self._read_folders(spark, read, schema).select(*schema.names).where(~F.coalesce(cond, F.lit(False)))
        write_partitioned(left, path, self.partition_by)
        self._replace(spark, read, path, "delete")

    def changes(self, spark: SparkSession, since: int, until: int | None = None) -> DataFrame:
        """Signed rows between two versions: ``weight`` -1 for those of folders that went, +1 for those that came.

        Rows that a rewrite copied unchanged appear with both signs; sums of weights are exact.
        """
        _, old, schema = self._state(spark, since)
        _, new, _ = self._state(spark, until)
        signed = lambda folders, w: self._read_folders(spark, sorted(folders), schema).select(*schema.names, F.lit(w).alias("weight"))
        return signed(set(old) - set(new), -1).unionByName(signed(set(new) - set(old), 1))

    def file_sizes(self, spark: SparkSession) -> DataFrame:
        """(partition columns..., file, bytes, rows) of the latest version."""
        return self._files(spark)[0]

    def _files(self, spark: SparkSession) -> tuple[DataFrame, list[str], T.StructType]:
        """One row per file: partition columns, folder, file, bytes, rows."""
        _, folders, schema = self._state(spark)
        f = self._read_folders(spark, folders, schema)
        about = ("file_path", "file_size") if folders else (None, None)  # an empty table has no files
        each = f.select(*self.partition_by, *[(F.col(f"_metadata.{m}") if m else F.lit(None)).alias(n) for m, n in zip(about, ("file", "bytes"))])
        return each.groupBy(*self.partition_by, "file", "bytes").agg(F.count(F.lit(1)).alias("rows")), folders, schema

    def layout(self, spark: SparkSession) -> DataFrame:
        """(partition columns..., files, rows) from the file-source metadata column."""
        files, _, _ = self._files(spark)
        return files.groupBy(*self.partition_by).agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))

    def compact(self, spark: SparkSession, where: Column | None = None, target_rows_per_file: int = 5_000_000,
                mode: str = "major", min_files: int = 2, sort_by: list[str] | None = None) -> None:
        """Rewrite chosen partitions into ceil(rows / target) files each.

        ``mode="minor"`` only touches partitions holding at least ``min_files``
        files (merging small files); ``mode="major"`` rewrites every chosen
        partition, optionally clustered by ``sort_by``.
        """
        if mode not in ("minor", "major"):
            raise ValueError(f"unknown compaction mode {mode}")
        layout = self.layout(spark) if where is None else self.layout(spark).where(where)
        parts = [tuple(r[c] for c in self.partition_by) for r in layout.collect() if mode == "major" or r["files"] >= min_files]
        if not parts:
            return
        _, folders, schema = self._state(spark)
        chosen = in_partitions(parts, self.partition_by, schema)
        read = self._where(spark, chosen, folders, schema)
        files, path = F.ceil(F.count(F.lit(1)) / F.lit(target_rows_per_file)), self._new_folder()
        write_exact(self._read_folders(spark, read, schema).select(*schema.names), path, self.partition_by, files, sort_by)
        self._replace(spark, read, path, "compact")


    def compact_small_files(self, spark: SparkSession, target_bytes: int = 128 << 20, small_share: float = 0.5) -> DataFrame:
        """Merge small files by bin packing and leave all others untouched; returns (partition..., file, bytes) of those read.

        Files below ``small_share`` of the target are packed by first-fit decreasing
        into bins of ``target_bytes``, within their partition; a bin of one file stays as it
        is.  Only the files of the other bins are read, and each bin becomes one file.
        """
        files, entries, schema = self._files(spark)
        plan, bins = [], 0
        by_partition: dict[tuple, list] = {}
        for r in files.where(F.col("bytes") < F.lit(int(target_bytes * small_share))).collect():  # one row per small file
            by_partition.setdefault(tuple(r[c] for c in self.partition_by), []).append((r["bytes"], r["file"]))
        for part in sorted(by_partition, key=str):
            for packed in first_fit_decreasing(by_partition[part], target_bytes):
                if len(packed) > 1:
                    plan += [(*part, file, size, bins) for size, file in packed]
                    bins += 1
        fields = [*[schema[c] for c in self.partition_by], T.StructField("file", T.StringType()), T.StructField("bytes", T.LongType()), T.StructField("_bin", T.IntegerType())]
        moved = spark.createDataFrame(plan, T.StructType(fields))
        if plan:
            known, gone = set(entries), {self._relative(p[-3]) for p in plan}
            read = sorted({self._entry(p[-3], known) for p in plan})
            stay = [f for e in read if e in known and not e.endswith(".parquet") for f in self._files_in(spark, e) if f not in gone]
            src = self._read_folders(spark, sorted(gone), schema).withColumn("_file", F.col("_metadata.file_path"))
            dealt = src.join(F.broadcast(moved.select(F.col("file").alias("_file"), "_bin")), "_file").repartitionById(bins, "_bin")
            path = self._new_folder()
            dealt.select(*schema.names).write.mode("overwrite").partitionBy(*self.partition_by).parquet(path)
            self._replace(spark, read, path, "compact small files", stay)
        return moved.drop("_bin")

    def _relative(self, uri: str) -> str:
        return "/".join(unquote(uri).rsplit("/", len(self.partition_by) + 2)[1:])

    def _files_in(self, spark: SparkSession, entry: str) -> list[str]:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.data_path}/{entry}")
        found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
        return [f"{entry}/{n}" for n in (f.getPath().getName() for f in found) if n.endswith(".parquet")]


def first_fit_decreasing(items: list[tuple[int, str]], size: int) -> list[list[tuple[int, str]]]:
    """Bins of at most ``size``: each item, largest first, goes to the first bin that still holds it."""
    bins: list[list] = []
    left: list[int] = []
    for item in sorted(items, key=lambda x: (-x[0], x[1])):
        at = next((i for i, room in enumerate(left) if room >= item[0]), None)
        if at is None:
            bins.append([item])
            left.append(size - item[0])
        else:
            bins[at].append(item)
            left[at] -= item[0]
    return bins


def layout_profile(spark: SparkSession, path: str, partition_by: list[str]) -> DataFrame:
    """(partition columns..., files, rows) of one folder from the file-source metadata column."""
    t = spark.read.parquet(path)
    return t.groupBy(*partition_by).agg(F.countDistinct("_metadata.file_path").alias("files"),
                                        F.count(F.lit(1)).alias("rows"))


# --------------------------------------------------------------------------- named references (branches)


_REFS = "seq long, ref string, location string, op string, at timestamp_ntz"


@dataclass
class TableRefs:
    """Named references (``main``, branches) to table locations, kept as an append-only log.

    The current target of a reference is its latest log row; a drop appends a
    tombstone.  Publishing a branch is one appended row, so readers switch
    from the old location to the new one at once and the old files stay
    readable for anyone still holding them.
    """
    root: str

    def _log(self, spark: SparkSession) -> DataFrame | None:
        return read_or_none(spark, self.root, _REFS)

    def _append(self, spark: SparkSession, ref: str, location: str | None, op: str, at: str) -> None:
        def build(log):
            last = log.agg(F.max("seq")).first()[0] if log is not None else None
            seq = 0 if last is None else last + 1
            return seq, spark.range(1).select(F.lit(seq).cast("long").alias("seq"), F.lit(ref).alias("ref"), F.lit(location).cast("string").alias("location"),
                                              F.lit(op).alias("op"), F.lit(at).cast("timestamp_ntz").alias("at"))

        commit(spark, self.root, _REFS, build)

    def set(self, spark: SparkSession, ref: str, location: str, at: str, op: str = "set") -> None:
        self._append(spark, ref, location, op, at)

    def drop(self, spark: SparkSession, ref: str, at: str) -> None:
        self._append(spark, ref, None, "drop", at)

    def listing(self, spark: SparkSession) -> DataFrame:
        """Live references: (ref, location, op, at) of each reference's latest row, tombstones removed."""
        log = self._log(spark)
        latest = log.groupBy("ref").agg(F.max_by(F.struct("location", "op", "at"), F.col("seq")).alias("r"))
        return latest.select("ref", "r.location", "r.op", "r.at").where(F.col("location").isNotNull())

    def resolve(self, spark: SparkSession, ref: str) -> str:
        row = self.listing(spark).where(F.col("ref") == ref).select("location").first()
        if row is None:
            raise KeyError(ref)
        return row[0]


# --------------------------------------------------------------------------- snapshots


_SNAPSHOTS = "snapshot_id long, parent_id long, committed_at timestamp_ntz, operation string, rows_added long, attempt string"


@dataclass
class SnapshotTable:
    root: str

    @property
    def data_path(self) -> str:
        return f"{self.root}/data"

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    def _log(self, spark: SparkSession) -> DataFrame | None:
        return read_or_none(spark, self.log_path, _SNAPSHOTS)

    def append(self, spark: SparkSession, df: DataFrame, committed_at: str, operation: str = "append") -> int:
        """Append ``df`` as a new snapshot; returns its id.

        The rows go to a folder of this attempt alone; the log row names it, so no writer
        touches another's rows, and those of an attempt without a log row are never read.
        """
        log = self._log(spark)
        if log is not None:
            log.agg(F.max("snapshot_id")).first()  # an unreadable log stops the append before anything is written
        attempt = uuid.uuid4().hex
        df.write.parquet(f"{self.data_path}/attempt={attempt}")
        added = spark.read.parquet(f"{self.data_path}/attempt={attempt}").count()

        def build(log):
            last = log.agg(F.max("snapshot_id")).first()[0] if log is not None else None
            sid = (last or 0) + 1
            return sid, spark.range(1).select(
                F.lit(sid).cast("long").alias("snapshot_id"), F.lit(last).cast("long").alias("parent_id"),
                F.lit(committed_at).cast("timestamp_ntz").alias("committed_at"), F.lit(operation).alias("operation"),
                F.lit(added).cast("long").alias("rows_added"), F.lit(attempt).alias("attempt"))

        return commit(spark, self.log_path, _SNAPSHOTS, build)

    def history(self, spark: SparkSession) -> DataFrame:
        """(snapshot_id, parent_id, committed_at, operation, rows_added, total_rows, is_current_ancestor)."""
        log = self._log(spark).drop("attempt")
        w = Window.orderBy("snapshot_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # The log holds one row per commit: a tiny table, so a global window is fine.
        return log.withColumn("total_rows", F.sum("rows_added").over(w)).withColumn(
            "is_current_ancestor", F.lit(True))

    def read(self, spark: SparkSession, version: int | None = None, as_of: str | None = None) -> DataFrame:
        """Rows visible at ``version`` (or at time ``as_of``); latest when neither is given."""
        log = self._log(spark)
        if as_of is not None:
            version = log.where(F.col("committed_at") <= F.lit(as_of).cast("timestamp_ntz")).agg(
                F.max("snapshot_id")).first()[0]
            if version is None:
                raise ValueError(f"no snapshot at or before {as_of}")
        seen = log if version is None else log.where(F.col("snapshot_id") <= F.lit(version))
        seen = seen.select(F.col("attempt").alias("_a"), "snapshot_id").collect()  # one row per snapshot
        paths = [f"{self.data_path}/attempt={r['_a']}" for r in seen]
        data = spark.read.option("basePath", self.data_path).parquet(*paths)
        ids = F.broadcast(spark.createDataFrame(seen, "_a string, snapshot_id long"))
        return data.join(ids, F.col("attempt") == F.col("_a")).drop("attempt", "_a")
