"""Declarative data-quality tests, gates, cleansing and write-audit-publish.

Every test is a single aggregate that returns one row
``(test, failures, should_warn, should_error)``; several tests are combined
with ``unionByName`` and evaluated in one job.  Only that small result frame
reaches the driver (gates, branches) — never the data under test.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import scratch_path


class DataQualityError(RuntimeError):
    """Raised by :func:`gate` when a test reaches its error level (or no result exists)."""


def _result(name: str, failures: Column, warn_above: int, error_above: int) -> list[Column]:
    return [
        F.lit(name).alias("test"),
        failures.alias("failures"),
        (failures > F.lit(warn_above)).alias("should_warn"),
        (failures > F.lit(error_above)).alias("should_error"),
    ]


def unique_test(df: DataFrame, cols: str | list[str], name: str, warn_above: int = 0, error_above: int = 0,
                hash_long_text: bool = False) -> DataFrame:
    """Number of key values (non-NULL) that occur more than once.

    With ``hash_long_text`` the key is the SHA-256 of the whole value, so a
    shuffle moves 32-byte digests instead of full documents.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    not_null = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        not_null = not_null & F.col(c).isNotNull()
    keyed = df.where(not_null)
    if hash_long_text:
        keys = [F.sha2(F.col(c).cast("string"), 256).alias(f"_k{i}") for i, c in enumerate(cols)]
    else:
        keys = [F.col(c) for c in cols]
    dup_keys = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return dup_keys.agg(*_result(name, F.count(F.lit(1)), warn_above, error_above))


@dataclass(frozen=True)
class RowTest:
    """A count-style test: rows matching ``failing`` (SQL predicate) are failures."""
    name: str
    failing: str
    warn_above: int = 0
    error_above: int = 0


def length_rule(col: str, length: int, name: str, warn_above: int = 0, error_above: int = 0) -> RowTest:
    return RowTest(name, f"length(`{col}`) != {length}", warn_above, error_above)


def pattern_rule(col: str, regex: str, name: str, warn_above: int = 10, error_above: int = 1000) -> RowTest:
    escaped = regex.replace("\\", "\\\\").replace("'", "\\'")
    return RowTest(name, f"`{col}` rlike '{escaped}'", warn_above, error_above)


def scan_tests(df: DataFrame, tests: list[RowTest]) -> DataFrame:
    """Evaluate many count-style tests with ONE pass over ``df`` (one aggregate, one row per test)."""
    counts = df.agg(*[F.count(F.when(F.expr(t.failing), F.lit(1))).alias(f"_t{i}") for i, t in enumerate(tests)])
    rows = F.array(*[F.struct(F.lit(t.name).alias("test"), F.col(f"_t{i}").alias("failures"),
                              (F.col(f"_t{i}") > F.lit(t.warn_above)).alias("should_warn"),
                              (F.col(f"_t{i}") > F.lit(t.error_above)).alias("should_error"))
                     for i, t in enumerate(tests)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def length_test(df: DataFrame, col: str, length: int, name: str, warn_above: int = 0, error_above: int = 0) -> DataFrame:
    return scan_tests(df, [length_rule(col, length, name, warn_above, error_above)])


def pattern_test(df: DataFrame, col: str, regex: str, name: str, warn_above: int = 10,
                 error_above: int = 1000) -> DataFrame:
    return scan_tests(df, [pattern_rule(col, regex, name, warn_above, error_above)])


def run_tests(tests: Iterable[DataFrame]) -> DataFrame:
    tests = list(tests)
    out = tests[0]
    for t in tests[1:]:
        out = out.unionByName(t)
    return out


def with_status(results: DataFrame) -> DataFrame:
    return results.withColumn(
        "status", F.when(F.col("should_error"), "error").when(F.col("should_warn"), "warn").otherwise("pass"))


@dataclass
class GateOutcome:
    passed: list[str]
    warned: list[str]


def gate(results: DataFrame, log: Callable[[str], None] = print) -> GateOutcome:
    """Raise on any error-level test, report warnings, pass otherwise.

    ``results`` has one row per test, so collecting it is bounded by the
    number of tests.  No rows at all is itself an error (the test did not run).
    """
    rows = with_status(results).select("test", "failures", "status").collect()
    if not rows:
        raise DataQualityError("no test result")
    errors = [r for r in rows if r["status"] == "error"]
    if errors:
        raise DataQualityError("; ".join(f"{r['test']}: {r['failures']} failures" for r in errors))
    warned = [r["test"] for r in rows if r["status"] == "warn"]
    for r in rows:
        if r["status"] == "warn":
            log(f"warning: {r['test']}: {r['failures']} failures")
    return GateOutcome([r["test"] for r in rows if r["status"] == "pass"], warned)


def first_row_true(df: DataFrame) -> bool:
    """Truthiness of the first column of the first row (False when there is no row)."""
    row = df.limit(1).collect()
    return bool(row and row[0][0])


# --------------------------------------------------------------------------- column / table checks


def column_checks(df: DataFrame, spec: dict[str, dict[str, dict[str, int]]]) -> DataFrame:
    """Checks like ``{"c_custkey": {"null_check": {"equal_to": 0}, "distinct_check": {"geq_to": 2}}}``.

    All measures come from one aggregate; the result is long format
    ``(column, check, value, passed)``.
    """
    measures, rows = [], []
    for col, checks in spec.items():
        for check, cond in checks.items():
            alias = f"{col}__{check}"
            if check == "null_check":
                measures.append((F.count(F.lit(1)) - F.count(col)).alias(alias))
            elif check == "distinct_check":
                measures.append(F.countDistinct(col).alias(alias))
            elif check == "unique_check":
                measures.append((F.count(col) - F.countDistinct(col)).alias(alias))
            else:
                raise ValueError(f"unknown check {check}")
            (op, bound), = cond.items()
            rows.append((col, check, alias, op, bound))
    checked = [F.struct(F.lit(col).alias("column"), F.lit(check).alias("check"), F.col(alias).cast("long").alias("value"),
                        _compare(F.col(alias), op, bound).alias("passed")) for col, check, alias, op, bound in rows]
    return df.agg(*measures).select(F.explode(F.array(*checked)).alias("c")).select("c.*")


def _compare(v: Column, op: str, bound) -> Column:
    if op == "equal_to":
        return v == bound
    if op == "geq_to":
        return v >= bound
    if op == "leq_to":
        return v <= bound
    if op == "greater_than":
        return v > bound
    if op == "less_than":
        return v < bound
    if op == "between":
        lo, hi = bound
        return v.between(lo, hi)
    raise ValueError(f"unknown comparison {op}")


def table_checks(df: DataFrame, name: str, checks: dict[str, tuple[str, object]]) -> DataFrame:
    """Row-count checks, e.g. ``{"row_count_check": ("between", (1, 10**9))}`` → (table, check, value, passed)."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    checked = [F.struct(F.lit(name).alias("table"), F.lit(c).alias("check"), F.col("n").alias("value"),
                        _compare(F.col("n"), op, bound).alias("passed")) for c, (op, bound) in checks.items()]
    return n.select(F.explode(F.array(*checked)).alias("c")).select("c.*")


def referential_test(fact: DataFrame, fk: str, dim: DataFrame, pk: str, name: str) -> DataFrame:
    """Rows of ``fact`` whose non-NULL ``fk`` has no ``pk`` in ``dim`` (anti join, counted)."""
    orphans = fact.where(F.col(fk).isNotNull()).join(dim.select(F.col(pk).alias(fk)), fk, "left_anti")
    return orphans.agg(*_result(name, F.count(F.lit(1)), 0, 0))


# --------------------------------------------------------------------------- cleansing and WAP


def cleanse(df: DataFrame, strip_col: str, strip_regex: str, length_col: str, length: int) -> DataFrame:
    """Delete rows whose ``length_col`` has the wrong length; strip ``strip_regex`` matches from ``strip_col``.

    Like SQL ``DELETE ... WHERE length(c) != n``, a row whose condition is NULL is kept.
    """
    kept = df.where(~F.coalesce(F.length(length_col) != length, F.lit(False)))
    cleaned = F.when(F.col(strip_col).rlike(strip_regex), F.regexp_replace(strip_col, strip_regex, "")).otherwise(
        F.col(strip_col))
    return kept.withColumn(strip_col, cleaned)


@dataclass
class PublishedTable:
    location: str
    audit: DataFrame
    refs: object  # tables.TableRefs

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.location)


def write_audit_publish(spark: SparkSession, main: DataFrame, transform: Callable[[DataFrame], DataFrame],
                        audits: Callable[[DataFrame], DataFrame], name: str,
                        at: str = "2024-01-01 00:00:00") -> PublishedTable:
    """Branch, edit, audit, publish, drop the branch — without ever rewriting ``main`` in place.

    ``main`` is written once as the table's first location; the edited data
    goes to a new branch location.  A failed audit raises and leaves ``main``
    pointing where it was; a passed audit moves ``main`` to the branch's
    location (one appended reference row) and drops the branch name.
    """
    from contrail.operators.tables import TableRefs

    refs = TableRefs(scratch_path(spark, f"{name}-refs"))
    main_loc = scratch_path(spark, f"{name}-main")
    main.write.mode("overwrite").parquet(main_loc)
    refs.set(spark, "main", main_loc, at, op="create")
    branch_loc = scratch_path(spark, f"{name}-branch")
    transform(spark.read.parquet(refs.resolve(spark, "main"))).write.mode("overwrite").parquet(branch_loc)
    refs.set(spark, "branch_qa", branch_loc, at, op="branch")
    results = audits(spark.read.parquet(branch_loc))
    gate(results, log=lambda _m: None)
    refs.set(spark, "main", branch_loc, at, op="publish")
    refs.drop(spark, "branch_qa", at)
    return PublishedTable(refs.resolve(spark, "main"), with_status(results), refs)
