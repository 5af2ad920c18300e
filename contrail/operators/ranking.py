"""Top-N per group and identifier assignment.

Top-N per group uses ``row_number() <= n`` over a window; Spark plans a
partial ``WindowGroupLimit`` before the shuffle, so a hot group ships at most
n rows per input partition instead of all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank_col: str = "rn") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def ranked_string(df: DataFrame, group: list[str], rank_col: str, text: Column, out: str) -> DataFrame:
    """Concatenate ``text`` of each group's ranked rows in rank order.

    Input holds at most n rows per group (after ``top_n_per_group``), so the
    collected list is bounded by n.
    """
    items = F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"), text.alias("t"))))
    return df.groupBy(*group).agg(F.concat_ws("", F.transform(items, lambda x: x["t"])).alias(out))


def dense_sequence(df: DataFrame, order: list[str], id_col: str = "id") -> DataFrame:
    """Dense ids 1..N in ``order`` without a single-partition window.

    1. range-partition + sort by the order key and a row hash (parallel sort, hot keys split);
    2. checkpoint to the shared folder, so both passes below read the very same rows;
    3. count rows per partition (one row per partition), turn counts into offsets;
    4. id = offset of the partition + position inside it.
    """
    spark = df.sparkSession
    from contrail.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    # The hash of the whole row breaks ties, so rows sharing one order-key value
    # (a hot key) still spread over several range partitions.
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    keyed = (
        df.orderBy(*order, tie)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = keyed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per partition: a bounded broadcast and a tiny global window.
    offsets = counts.withColumn("_off", F.sum("_n").over(w) - F.col("_n")).select("_pid", "_off", "_first")
    out = keyed.join(F.broadcast(offsets), "_pid")
    return out.withColumn(id_col, (F.col("_off") + F.col("_mid") - F.col("_first") + 1).cast("long")).drop(
        "_pid", "_mid", "_off", "_first")


def surrogate_key(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Unique (gapped, partition-prefixed) 64-bit ids, computed without a shuffle."""
    return df.withColumn(id_col, F.monotonically_increasing_id())
