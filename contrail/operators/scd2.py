"""Slowly-changing dimension, type 2: change feed and merge.

A merge is one full outer join of the dimension's *current* rows with the
staged snapshot on the business key; closed history rows pass through
untouched.  Each key is compared only with its open version, so re-running a
merge never re-closes history (and the result is the same as running it once).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scd2Options:
    key: str = "code"
    attrs: tuple[str, ...] = ("description",)
    open_end: str | None = "9999-01-01"   # None: open rows have valid_to NULL
    time_type: str = "timestamp_ntz"        # or "date"
    with_deletes: bool = True               # keys missing from the stage get closed
    with_updated_at: bool = True


VARIANT_A = Scd2Options()
VARIANT_B = Scd2Options(open_end=None, time_type="date", with_deletes=False)
VARIANT_C = Scd2Options(open_end=None, time_type="date", with_deletes=False, with_updated_at=False)


def _t(value: str, opts: Scd2Options) -> Column:
    return F.lit(value).cast(opts.time_type)


def _open_end(opts: Scd2Options) -> Column:
    return _t(opts.open_end, opts) if opts.open_end else F.lit(None).cast(opts.time_type)


def _is_open(opts: Scd2Options) -> Column:
    return F.col("valid_to") == _t(opts.open_end, opts) if opts.open_end else F.col("valid_to").isNull()


def _columns(opts: Scd2Options) -> list[str]:
    cols = [opts.key, *opts.attrs]
    if opts.with_updated_at:
        cols.append("updated_at")
    return cols + ["valid_from", "valid_to"]


def initial_load(src: DataFrame, opts: Scd2Options, loaded_at: str, valid_from: str) -> DataFrame:
    """Every source row as an open version."""
    out = src.select(opts.key, *opts.attrs)
    if opts.with_updated_at:
        out = out.withColumn("updated_at", _t(loaded_at, opts))
    return out.withColumn("valid_from", _t(valid_from, opts)).withColumn("valid_to", _open_end(opts))


def _changed(opts: Scd2Options, left: str = "d", right: str = "s") -> Column:
    cond = F.lit(False)
    for a in opts.attrs:
        cond = cond | ~F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{a}"))
    return cond


def _sides(cur: DataFrame, stage: DataFrame, opts: Scd2Options) -> tuple[DataFrame, Column, Column]:
    """Full outer join of open rows (``d``) and stage (``s``), and a column per side that says whether its row is there.

    The sides carry marks of their own, so an open row whose key is null is a row like any other.
    """
    d = cur.withColumn("__in_dim", F.lit(True)).alias("d")
    s = stage.select(opts.key, *opts.attrs).withColumn("__in_stage", F.lit(True)).alias("s")
    j = d.join(s, F.col(f"d.{opts.key}") == F.col(f"s.{opts.key}"), "full_outer")
    return j, F.col("__in_dim").isNotNull(), F.col("__in_stage").isNotNull()


def change_feed(dim: DataFrame, stage: DataFrame, opts: Scd2Options = VARIANT_A) -> DataFrame:
    """Tag every change: update-close, update-insert, insert, delete → (ops, join_key, key, attrs...)."""
    check_stage(stage, opts)
    j, in_dim, in_stage = _sides(dim.where(_is_open(opts)).select(opts.key, *opts.attrs), stage, opts)
    both, dkey = in_dim & in_stage, F.col(f"d.{opts.key}")
    skey = F.col(f"s.{opts.key}")

    def tagged(tag: str, join_key: Column | None, side: str) -> Column:
        jk = join_key if join_key is not None else F.lit(None).cast(dim.schema[opts.key].dataType)
        return F.struct(F.lit(tag).alias("ops"), jk.alias("join_key"),
                        *[F.col(f"{side}.{c}").alias(c) for c in (opts.key, *opts.attrs)])

    # One pass over the join; each joined row emits the change rows it stands for.
    changes = [
        F.when(both & _changed(opts), tagged("update - change the old row", skey, "s")),
        F.when(both & _changed(opts), tagged("update - insert row", None, "s")),
        F.when(~in_dim, tagged("insert", None, "s")),
    ]
    if opts.with_deletes:  # a null key names no carrier, so a stage cannot leave it out
        changes.append(F.when(~in_stage & dkey.isNotNull(), tagged("delete", dkey, "d")))
    return j.select(F.explode(F.array(*changes)).alias("c")).where(F.col("c").isNotNull()).select("c.*")


class DuplicateKeyError(ValueError):
    """The staged snapshot names a key more than once."""


class NullKeyError(ValueError):
    """The staged snapshot holds rows without a key."""


def check_stage(stage: DataFrame, opts: Scd2Options) -> None:
    """Refuse a stage in which a key is null or named twice."""
    bad = stage.groupBy(opts.key).count().where((F.col("count") > 1) | F.col(opts.key).isNull()).select(opts.key).limit(5).collect()
    if any(r[0] is None for r in bad):
        raise NullKeyError(f"stage holds rows whose {opts.key} is null")
    if bad:
        raise DuplicateKeyError(f"stage holds several rows for {opts.key} {[r[0] for r in bad]}")


def merge_into(dim: str, refs, stage: DataFrame, as_of: str, opts: Scd2Options = VARIANT_A) -> DataFrame:
    """Merge ``stage`` into the table that reference ``dim`` names: write the new version, then move the reference."""
    spark = stage.sparkSession
    new = merge(spark.read.parquet(refs.resolve(spark, dim)), stage, as_of, opts)
    path = f"{refs.root}-{dim}-{uuid.uuid4().hex[:12]}"
    new.write.parquet(path)
    refs.set(spark, dim, path, as_of, "merge")
    return spark.read.schema(new.schema).parquet(path)


def merge(dim: DataFrame, stage: DataFrame, as_of: str, opts: Scd2Options = VARIANT_A) -> DataFrame:
    """New dimension table after applying ``stage`` at time ``as_of``.

    A stage with a null or repeated key is refused.  Open rows of the dimension whose key is null
    match nothing and stay as they are.
    """
    check_stage(stage, opts)
    cols = _columns(opts)
    history = dim.where(~F.coalesce(_is_open(opts), F.lit(False))).select(*cols)
    j, in_dim, in_stage = _sides(dim.where(_is_open(opts)).select(*cols), stage, opts)
    changed = in_dim & in_stage & _changed(opts)
    close = changed | (in_dim & ~in_stage & F.col(f"d.{opts.key}").isNotNull()) if opts.with_deletes else changed
    now = _t(as_of, opts)

    def version(side: str, updated: Column | None, valid_from: Column, valid_to: Column) -> Column:
        out = [F.col(f"{side}.{c}").alias(c) for c in (opts.key, *opts.attrs)]
        if opts.with_updated_at:
            out.append(updated.cast(opts.time_type).alias("updated_at"))
        return F.struct(*out, valid_from.cast(opts.time_type).alias("valid_from"),
                        valid_to.cast(opts.time_type).alias("valid_to"))

    # One pass over the join: every joined row emits its 0..2 output versions.
    versions = F.array(
        F.when(in_dim & ~close, version("d", F.col("d.updated_at") if opts.with_updated_at else None,
                                        F.col("d.valid_from"), F.col("d.valid_to"))),
        F.when(close, version("d", now, F.col("d.valid_from"), now)),
        F.when(in_stage & (~in_dim | changed), version("s", now, now, _open_end(opts))),
    )
    current = j.select(F.explode(versions).alias("v")).where(F.col("v").isNotNull()).select("v.*")
    return history.unionByName(current)
