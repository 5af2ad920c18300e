"""Property (metamorphic) checks on small random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contrail.operators import scd2
from contrail.plans.maintenance import build_rollup, refresh_rollup

codes = st.sampled_from(["A", "B", "C", "D", "E"])
descs = st.sampled_from(["x", "y", "z"])
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(dim=st.dictionaries(codes, descs, min_size=1), stage=st.dictionaries(codes, descs))
def test_scd2_merge_invariants(spark, dim, stage):
    d0 = scd2.initial_load(spark.createDataFrame(list(dim.items()), "code string, description string"),
                           scd2.VARIANT_A, "2021-01-01 00:00:00", "2021-01-01 00:00:00")
    s = spark.createDataFrame(list(stage.items()) or [("Z", "z")], "code string, description string")
    if not stage:
        s = s.where("false")
    out = scd2.merge(d0, s, "2024-01-01 00:00:00", scd2.VARIANT_A)
    rows = out.collect()
    open_rows = {r.code: r.description for r in rows if str(r.valid_to).startswith("9999")}
    assert open_rows == stage                                        # open versions == the stage
    assert sum(1 for r in rows if not str(r.valid_to).startswith("9999")) == \
        sum(1 for k, v in dim.items() if stage.get(k) != v)          # one closed row per changed/deleted key
    again = scd2.merge(out, s, "2025-01-01 00:00:00", scd2.VARIANT_A)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))  # idempotent


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(1999, 2002), st.integers(1, 12), st.integers(0, 3),
                               st.one_of(st.none(), st.integers(-20, 40)), st.integers(0, 1)), min_size=1, max_size=40),
       cut=st.integers(1999, 2003))
def test_incremental_refresh_equals_rebuild(spark, rows, cut):
    f = spark.createDataFrame(rows, "year int, month int, uniquecarrier int, depdelay int, cancelled int")
    al = spark.createDataFrame([(i, f"Airline {i}") for i in range(4)], "code int, description string")
    full = build_rollup(f, al)
    base = build_rollup(f.where(F.col("year") < cut), al)
    inc = refresh_rollup(base, build_rollup(f.where(F.col("year") >= cut), al))
    assert sorted(map(tuple, inc.select(*full.columns).collect())) == sorted(map(tuple, full.collect()))
