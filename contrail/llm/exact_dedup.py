"""Exact dedup by content sort.

Rows are range-partitioned on sampled splitters of the normalised bytes, sorted
within each partition (Spark's external sort), and every row is compared in
full with its left neighbour.  A splitter is the first 32 bytes, a 64-bit
content hash and the identifier, so that what the driver samples stays small
however long the texts are, and a text that a third of all rows share is cut
between partitions at identifiers.  Runs that cross a partition boundary are
joined through the digests of each partition's first and last run.

Cases: null text counts as empty; rows with a null id take part (they sort
first, so they stay only if their whole group has null ids); of rows repeated
with the same id and text exactly one is kept; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import attach, ship_code, utf8, written

_RUNS = "doc_id long, pid int, run long, pos long, text_sha256 string"


def _mark_runs(batches):
    """Number the runs of equal neighbours of one sorted partition."""
    pid = TaskContext.get().partitionId()
    prev, run, pos, sha = None, -1, 0, ""
    for batch in batches:
        runs, shas, texts = [], [], batch.column("t").to_pylist()
        for t in texts:
            if t != prev:
                prev, run, sha = t, run + 1, hashlib.sha256(t).hexdigest()
            runs.append((pid << 40) | run)
            shas.append(sha)
        n = len(texts)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([pid] * n, pa.int32()), pa.array(runs, pa.int64()),
             pa.array(range((pid << 40) | pos, ((pid << 40) | pos) + n), pa.int64()), pa.array(shas, pa.string())],
            names=["doc_id", "pid", "run", "pos", "text_sha256"])
        pos += n


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``text`` is the normalised text to compare (default: the text column as it
    is).  The row with the largest id of each group is kept.
    """
    ship_code(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col("text") if text is None else text).alias("t"))
    keyed = rows.select("doc_id", F.substring("t", 1, 32).alias("p"), F.xxhash64("t").alias("h"), "t")
    ranged = keyed.repartitionByRange("p", "h", "doc_id").sortWithinPartitions("p", "h", "t", "doc_id")
    runs = written(ranged.select("doc_id", "t").mapInArrow(_mark_runs, _RUNS), "runs")

    # One row per partition: which first runs continue the last run of the partition before?
    ends = runs.groupBy("pid").agg(F.min("run").alias("first"), F.min_by("text_sha256", "run").alias("first_sha"),
                                   F.max("run").alias("last"), F.max_by("text_sha256", "run").alias("last_sha")).collect()
    root, moved, before = None, [], None
    for r in sorted(ends, key=lambda r: r["pid"]):
        if before is not None and before["last_sha"] == r["first_sha"]:
            moved.append((r["first"], root))
        else:
            root = r["first"]
        if r["last"] != r["first"]:
            root = r["last"]
        before = r
    spark = docs.sparkSession
    moves = spark.createDataFrame(moved, "run long, root long")
    rooted = runs.join(F.broadcast(moves), "run", "left").withColumn("root", F.coalesce("root", "run"))

    top = F.max(F.struct("pos", "doc_id"))
    facts = written(rooted.groupBy("root").agg(top["doc_id"].alias("keep_id"), top["pos"].alias("keep_pos"),
                                               F.count(F.lit(1)).alias("group_size"), F.count(F.lit(1)).alias("n")), "groups")
    total = facts.agg(F.sum("n")).first()[0] or 0
    out = attach(rooted.select("doc_id", "root", "pos", "text_sha256"), facts, "root", "n", "pos", total)
    return out.select("doc_id", "keep_id", "group_size", (F.col("pos") == F.col("keep_pos")).alias("kept"), "text_sha256")
