"""Mergeable sketches: KLL quantiles, HLL distinct counts, frequent items.

Sketches are built by Spark's own aggregate functions, so they combine
map-side like any partial aggregate and are stored as ``BinaryType``
columns.  Every answer has an exact twin computed from the same data, used
for bound checks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_K = 200        # KLL accuracy parameter (normalised rank error about 1.7 %)
HLL_LG_K = 12          # HLL log2 of the register count
FREQ_MAP_SIZE = 8192   # frequent-items map size

# Fixed split points of the lab's PMF / CDF queries.
SPLITS = [10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0, 80.0, 90.0, 100.0]
# Fixed quantiles of the lab's decile view.
DECILES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]


def quantile_sketch(value: Column, k: int = DEFAULT_K) -> Column:
    return F.kll_sketch_agg_double(value.cast("double"), k)


def ranks(sketch: str | Column, points: list[float]) -> Column:
    """Inclusive normalised ranks (fraction of items <= point)."""
    return F.kll_sketch_get_rank_double(F.col(sketch) if isinstance(sketch, str) else sketch,
                                        F.array(*[F.lit(float(p)) for p in points]))


def pmf_from_ranks(r: Column, n_points: int) -> Column:
    """Masses of (-inf, p1], (p1, p2], ..., (pn, +inf) from inclusive ranks at p1..pn."""
    masses = [r[0]] + [r[i] - r[i - 1] for i in range(1, n_points)] + [F.lit(1.0) - r[n_points - 1]]
    return F.array(*masses)


def quantiles(sketch: str | Column, qs: list[float]) -> Column:
    return F.kll_sketch_get_quantile_double(F.col(sketch) if isinstance(sketch, str) else sketch,
                                            F.array(*[F.lit(float(q)) for q in qs]))


def exact_bucket_counts(x: Column, points: list[float]) -> list[Column]:
    """Exact counts of the PMF buckets (same inclusive edges as :func:`pmf_from_ranks`)."""
    out = [F.count(F.when(x <= points[0], 1))]
    for lo, hi in zip(points, points[1:]):
        out.append(F.count(F.when((x > lo) & (x <= hi), 1)))
    out.append(F.count(F.when(x > points[-1], 1)))
    return out


def exact_rank_counts(x: Column, points: list[float]) -> list[Column]:
    return [F.count(F.when(x <= p, 1)) for p in points]


def distinct_sketch(value: Column, lg_k: int = HLL_LG_K) -> Column:
    return F.hll_sketch_agg(value, lg_k)


def frequent_items_sketch(item: Column, map_size: int = FREQ_MAP_SIZE) -> Column:
    return F.call_function("approx_top_k_accumulate", item, F.lit(map_size))


def frequent_items(sketch: str | Column, k: int) -> Column:
    """array<struct<item, count>> of the k most frequent items held by the sketch."""
    return F.call_function("approx_top_k_estimate", F.col(sketch) if isinstance(sketch, str) else sketch, F.lit(k))


def frequent_items_error(map_size: int = FREQ_MAP_SIZE) -> float:
    """Largest error of an item's estimate, as a share of all rows (the sketch's a-priori bound)."""
    return 3.5 / map_size


def merge_quantiles(sketch: str) -> Column:
    """One KLL sketch of all rows behind a group's stored sketches."""
    return F.kll_merge_agg_double(sketch)


def merge_items(sketch: str, map_size: int = FREQ_MAP_SIZE) -> Column:
    """One frequent-items sketch of all rows behind a group's stored sketches."""
    return F.call_function("approx_top_k_combine", F.col(sketch), F.lit(map_size))
