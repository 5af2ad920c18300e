"""Join helpers.

``dim_join`` is the one place that decides whether a side may be broadcast:
only after one aggregate has *proven* that the side holds at most ``max_rows``
rows and ``max_bytes`` bytes of string data.  Anything larger is left as a
shuffle join; adaptive execution may still turn it into a broadcast at run
time from measured shuffle sizes, and splits skewed partitions of a
sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024

_FIXED_WIDTH = {
    T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.BooleanType: 1,
}


def size_bound(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` by one aggregate with partial sums in every task (no limit, no single task).

    Variable-width columns are measured, fixed-width ones count by type size.
    """
    var_cols, fixed = [], 0
    for field in df.schema.fields:
        width = next((w for t, w in _FIXED_WIDTH.items() if isinstance(field.dataType, t)), None)
        if width is None:
            var_cols.append(field.name)
        else:
            fixed += width
    aggs = [F.count(F.lit(1)).alias("n")]
    if var_cols:
        lengths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in var_cols]
        aggs.append(F.sum(sum(lengths[1:], lengths[0])).alias("b"))
    row = df.agg(*aggs).first()
    n = int(row["n"])
    return n, n * fixed + (int(row["b"] or 0) if var_cols else 0)


_DECISIONS: dict[tuple, bool] = {}


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan (no job).

    For file scans it is the on-disk size of the files read, which never
    exceeds the decoded in-memory size, so an estimate above a limit proves
    the side is too big without reading it.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_broadcastable(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Proven-small check, remembered per application, plan and estimated size (a table that grew is measured anew).

    Sides whose estimate already exceeds ``max_bytes`` are rejected without a
    job; the others are measured by :func:`size_bound`, which then reads at
    most about ``max_bytes`` of input.
    """
    est = estimated_bytes(df)
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), est, max_rows, max_bytes)
    if key not in _DECISIONS:
        if est > max_bytes:
            _DECISIONS[key] = False
        else:
            rows, nbytes = size_bound(df)
            _DECISIONS[key] = rows <= max_rows and nbytes <= max_bytes
    return _DECISIONS[key]


def dim_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
             max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join a (possibly large) fact to a dimension, broadcasting the dimension only when proven small."""
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti", "semi", "anti", "cross"):
        return fact.join(dim, on, how)
    if is_broadcastable(dim, max_rows, max_bytes):
        dim = F.broadcast(dim)
    return fact.join(dim, on, how)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row relation (e.g. a high-water mark) to every row.

    Each column becomes a scalar subquery: Spark computes it once and uses
    the value like a literal, so no join (and no cartesian product) is planned.
    """
    out = df
    for c in one_row.columns:
        out = out.withColumn(c, one_row.select(c).scalar())
    return out
