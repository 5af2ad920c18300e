"""Grouped measures used across the lab queries.

Everything is a single ``groupBy().agg()`` so Spark plans a partial
(map-side) aggregate before the shuffle: a hot key costs one partial row per
input partition, not one shuffled row per input row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nvl0(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))


def count_if_positive(c: str | Column) -> Column:
    """``sum(case when nvl(c,0) > 0 then 1 end)`` — NULL (not 0) when nothing qualifies."""
    return F.sum(F.when(nvl0(c) > 0, F.lit(1)))


def delay_measures(prefix: str = "departure_delay", col: str = "depdelay") -> list[Column]:
    return [
        F.sum(nvl0(col)).alias(f"{prefix}_minutes"),
        count_if_positive(col).alias(f"{prefix}_count"),
    ]


def delay_by(df: DataFrame, *keys: str) -> DataFrame:
    """flights_count, departure_delay_minutes, departure_delay_count per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("flights_count"), *delay_measures())


def wide_profile(df: DataFrame, key: str = "tailnum") -> DataFrame:
    """Ten averages, five maxima and a count per key in one aggregate."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("flights_count"),
        F.avg("depdelay").alias("avg_delay"),
        F.max("depdelay").alias("max_depdelay"),
        F.avg("taxiout").alias("avg_taxiout"),
        F.avg("cancelled").alias("avg_cancelled"),
        F.avg("weatherdelay").alias("avg_weatherdelay"),
        F.max("weatherdelay").alias("max_weatherdelay"),
        F.avg("nasdelay").alias("avg_nasdelay"),
        F.max("nasdelay").alias("max_nasdelay"),
        F.avg("securitydelay").alias("avg_securitydelay"),
        F.max("securitydelay").alias("max_securitydelay"),
        F.avg("lateaircraftdelay").alias("avg_lateaircraftdelay"),
        F.max("lateaircraftdelay").alias("max_lateaircraftdelay"),
        F.avg("airtime").alias("avg_airtime"),
        F.avg("actualelapsedtime").alias("avg_actualelapsedtime"),
        F.avg("distance").alias("avg_distance"),
    )


def tasks_for(df: DataFrame, rows: int) -> int:
    """Shuffle partitions for ``rows`` rows of ``df`` each, the session's width at least."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // rows + 1)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """Global top-k: ``TakeOrderedAndProject`` keeps k rows per task, then k overall."""
    return df.orderBy(*order).limit(k)


def rollup_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("flights_count"),
        F.sum("cancelled").alias("cancelled"),
        *delay_measures(),
    ]
