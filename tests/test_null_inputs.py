"""Null keys, null features, impossible dates, large numbers; subqueries and names that masks must not leak."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contrail.operators import protect as pr
from contrail.operators import scd2
from contrail.operators import scoring as sc
from contrail.session import scratch_path
from contrail.streaming import pipeline as pl
from tests.conftest import SF_SMALL

KEYS = st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 4)), st.one_of(st.none(), st.sampled_from("ab"))), max_size=6)


@settings(max_examples=15, deadline=None)
@given(KEYS, KEYS)
def test_a_merge_loses_no_row(spark, dim_rows, stage_rows):
    opts = scd2.VARIANT_A
    seen = {k: v for k, v in dim_rows if k is not None}
    nulls = [(k, v) for k, v in dim_rows if k is None]
    stage = {k: v for k, v in stage_rows if k is not None}
    types = "code int, description string"
    dim = scd2.initial_load(spark.createDataFrame([*seen.items(), *nulls], types), opts, "2021-01-01 00:00:00", "2021-01-01 00:00:00")
    out = scd2.merge(dim, spark.createDataFrame(list(stage.items()), types), "2022-01-01 00:00:00", opts)
    open_rows = out.where("valid_to > '9000-01-01'")
    assert sorted(((r.code, r.description) for r in open_rows.collect()), key=str) == sorted([*stage.items(), *nulls], key=str)
    changed = sum(k not in stage or stage[k] != v for k, v in seen.items())
    assert out.count() == len(stage) + len(nulls) + changed
    feed = scd2.change_feed(dim, spark.createDataFrame(list(stage.items()), types), opts)
    assert feed.where("ops in ('insert', 'delete') and code is null").count() == 0


def test_a_stage_with_null_keys_is_refused(spark):
    dim = scd2.initial_load(spark.createDataFrame([(1, "a")], "code int, description string"), scd2.VARIANT_A, "2021-01-01", "2021-01-01")
    bad = spark.createDataFrame([(1, "b"), (None, "c")], "code int, description string")
    for call in (lambda: scd2.merge(dim, bad, "2022-01-01"), lambda: scd2.change_feed(dim, bad)):
        with pytest.raises(scd2.NullKeyError):
            call()


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.integers(-5, 3000))] * 5), min_size=1, max_size=8))
def test_feature_text_round_trips(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in sc.FEATURES))
    back = df.select(sc.feature_text(df).alias("t")).select(*sc.split_features("t"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_short_and_unreadable_feature_text(spark):
    df = spark.createDataFrame([("US,DCA",), ("",), (None,), ("1,2,3,4,5,6",), ("1,,3,x,99999999999",)], "t string")
    got = [tuple(r) for r in df.select(*sc.split_features("t")).collect()]
    assert got == [(None,) * 5, (None,) * 5, (None,) * 5, (1, 2, 3, 4, 5), (1, None, 3, None, None)]


def test_impossible_dates_are_scored(spark):
    from contrail.plans.scoring import stored_model

    rows = [(2001, 2, 30, 930, 1, 2, 3), (None, 1, 1, None, None, None, None), (2001, 13, 1, 2460, 1, 2, 3), (2001, 2, 28, 930, 1, 2, 3)]
    f = sc.with_features(spark.createDataFrame(rows, "year int, month int, dayofmonth int, deptime int, uniquecarrier int, origin int, dest int"))
    assert [r.week for r in f.collect()] == [None, None, None, 9]
    out = sc.score(stored_model(spark, SF_SMALL, "delay"), f, F.lit(7)).collect()
    assert len(out) == 4 and all(r.prediction in (0, 1) and 0.5 <= r.proba <= 1 for r in out)


def test_batch_and_stream_load_one_model(spark):
    """Fitted once; a stream that loads it gives the scores of the batch."""
    from contrail.plans.scoring import model_store, stored_model
    from contrail.sources.tables import flights

    f = sc.with_features(flights(spark, SF_SMALL)).select(*sc.FEATURES, "flightnum", "tailnum", "deptime").limit(500)
    path = scratch_path(spark, "t-score-in")
    f.write.parquet(path)
    key = F.col("flightnum") * 100003 + F.col("tailnum")
    cols = [*sc.FEATURES, "prediction", "proba", "prediction_delay"]
    batch = sc.score(stored_model(spark, SF_SMALL, "delay"), spark.read.parquet(path), key).select(*cols)
    stream = sc.score(stored_model(spark, SF_SMALL, "delay"), spark.readStream.schema(f.schema).parquet(path), key).select(*cols)
    out = scratch_path(spark, "t-score-out")
    pl.run_to_table(stream, out, scratch_path(spark, "t-score-ck"))
    assert sorted(map(tuple, batch.collect()), key=str) == sorted(map(tuple, spark.read.parquet(out).collect()), key=str)
    refs = model_store(spark, SF_SMALL, "delay")
    assert refs.listing(spark).count() == 1 and refs is model_store(spark, SF_SMALL, "delay")


def test_numbers_outside_their_type_do_not_stop_the_view(spark):
    raw = dict.fromkeys(pl.EVENT_COLUMNS, "1") | {"prediction": "{prediction=9e12, proba=0.5, prediction_delay=-9e300}", "weather_json": "{temp=1e400, all=x}", "ts": "no time"}
    df = spark.createDataFrame([raw, dict.fromkeys(pl.EVENT_COLUMNS)], pl.LANDING_SCHEMA)
    got = pl.typed_events(df).collect()
    assert got[0].prediction is None and got[0].prediction_delay is None and got[0].proba == 0.5 and got[0].event_ts is None
    assert all(v is None for v in got[1])


def _tagged(spark):
    cust = pr.tag(spark.createDataFrame([(1, "Ann", 3.0), (2, "Bob", 4.0)], "id long, name string, bal double"), {"name": {"PII"}})
    return cust, pr.Policy(denied_tags={"analyst": {"PII"}}, open_roles={"steward"})


def test_tags_pass_through_scalar_subqueries(spark):
    cust, policy = _tagged(spark)
    leak = cust.select("id").withColumn("x", cust.agg(F.max("name")).scalar())
    assert pr.enforce_tags(leak, policy, "analyst").columns == ["id"]
    inside = cust.select("id").withColumn("x", F.concat(F.lit("a"), cust.agg(F.max(F.upper("name"))).scalar()))
    assert pr.enforce_tags(inside, policy, "analyst").columns == ["id"]
    fine = cust.select("id").withColumn("x", cust.agg(F.max("bal")).scalar())
    assert pr.enforce_tags(fine, policy, "analyst").columns == ["id", "x"]


def test_tags_pass_through_in_and_exists(spark):
    cust, policy = _tagged(spark)
    cust.createOrReplaceTempView("tagged_customers")
    for cond in ("'Ann' IN (SELECT name FROM tagged_customers)", "EXISTS (SELECT 1 FROM tagged_customers WHERE name = 'Ann')",
                 "(SELECT count(*) FROM tagged_customers WHERE name LIKE 'A%')"):
        df = spark.sql(f"SELECT id, CASE WHEN bal > 0 THEN {cond} END AS told FROM tagged_customers")
        assert pr.enforce_tags(df, policy, "analyst").columns == ["id"], cond


@pytest.mark.parametrize("name, shown", [("José Ñuñez 李", "xxxx xxxxx x"), ("Ann-7 Ωmega", "xxx-x xxxxx"), ("éa", "xxx")])
def test_redact_covers_every_script(spark, name, shown):
    policy = pr.Policy(masks={"analyst": {"name": "redact"}})
    df = spark.createDataFrame([(name,)], "name string")
    assert pr.apply_masks(df, policy, "analyst").first()[0] == shown
