"""Data-quality queries: tests, gate statuses, checks, cleansing, branch and write-audit-publish."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.operators import quality as qa
from contrail.plans.registry import register
from contrail.session import scratch_path
from contrail.sources.tables import planes, table, with_views
from contrail.sources.tables import flights as flights_view


def _unique_tests(spark, d) -> list[DataFrame]:
    docs = table(spark, d, "documents")
    li = table(spark, d, "lineitem")
    return [
        qa.unique_test(docs, "doc_id", "documents_doc_id_unique"),
        qa.unique_test(docs, "text", "documents_text_unique", hash_long_text=True),
        qa.unique_test(li, ["l_orderkey", "l_linenumber"], "lineitem_key_unique"),
    ]


def _doc_rules(with_lengths: bool = True, with_quotes: bool = True, quote_levels=(10, 1000)) -> list[qa.RowTest]:
    rules = []
    if with_lengths:
        rules += [qa.length_rule("source", 4, "documents_source_len"), qa.length_rule("lang", 2, "documents_lang_len")]
    if with_quotes:
        rules.append(qa.pattern_rule("text", '"', "documents_text_quotes", *quote_levels))
    return rules


def _length_tests(spark, d, docs: DataFrame | None = None) -> list[DataFrame]:
    docs = docs if docs is not None else table(spark, d, "documents")
    return [qa.scan_tests(docs, _doc_rules(with_quotes=False))]


def _quote_tests(spark, d, docs: DataFrame | None = None, with_pages: bool = True) -> list[DataFrame]:
    docs = docs if docs is not None else table(spark, d, "documents")
    tests = [qa.scan_tests(docs, _doc_rules(with_lengths=False))]
    if with_pages:
        tests.append(qa.scan_tests(table(spark, d, "pages"), [qa.pattern_rule("html", '"', "pages_html_quotes")]))
    return tests


def _doc_tests(spark, d, docs: DataFrame | None = None, with_pages: bool = True) -> list[DataFrame]:
    """Length and quote tests on documents in one pass (+ pages in another)."""
    docs = docs if docs is not None else table(spark, d, "documents")
    tests = [qa.scan_tests(docs, _doc_rules())]
    if with_pages:
        tests.append(qa.scan_tests(table(spark, d, "pages"), [qa.pattern_rule("html", '"', "pages_html_quotes")]))
    return tests


def _t(name, failures_sql, frm, warn=0, err=0):
    return (f"SELECT '{name}' AS test, count(*) AS failures, count(*) > {warn} AS should_warn, "
            f"count(*) > {err} AS should_error FROM {frm}") if failures_sql is None else (
        f"SELECT '{name}' AS test, {failures_sql} AS failures, {failures_sql} > {warn} AS should_warn, "
        f"{failures_sql} > {err} AS should_error FROM {frm}")


_UNIQUE_SQL = " UNION ALL ".join([
    _t("documents_doc_id_unique", None,
       "(SELECT doc_id FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING count(*) > 1)"),
    _t("documents_text_unique", None,
       "(SELECT text FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1)"),
    _t("lineitem_key_unique", None,
       "(SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL "
       "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"),
])
_LEN = "count(CASE WHEN length({c}) != {n} THEN 1 END)"
_LENGTH_SQL = " UNION ALL ".join([
    _t("documents_source_len", _LEN.format(c="source", n=4), "{docs}"),
    _t("documents_lang_len", _LEN.format(c="lang", n=2), "{docs}"),
])
_Q = "count(CASE WHEN regexp_matches({c}, '\"') THEN 1 END)"
_QUOTE_SQL = " UNION ALL ".join([
    _t("documents_text_quotes", _Q.format(c="text"), "{docs}", 10, 1000),
    _t("pages_html_quotes", _Q.format(c="html"), "pages", 10, 1000),
])


@register("qa_unique", _UNIQUE_SQL)
def qa_unique(spark, d):
    return qa.run_tests(_unique_tests(spark, d))


@register("qa_length", _LENGTH_SQL.format(docs="documents"))
def qa_length(spark, d):
    return qa.run_tests(_length_tests(spark, d))


@register("qa_quote_marks", _QUOTE_SQL.format(docs="documents"))
def qa_quote_marks(spark, d):
    return qa.run_tests(_quote_tests(spark, d))


_STATUS = ("SELECT *, CASE WHEN should_error THEN 'error' WHEN should_warn THEN 'warn' ELSE 'pass' END AS status "
           "FROM ({q})")


@register("qa_gate", _STATUS.format(q=" UNION ALL ".join(
    [_UNIQUE_SQL, _LENGTH_SQL.format(docs="documents"), _QUOTE_SQL.format(docs="documents")])))
def qa_gate(spark, d):
    """Status of every test as the gate sees it; :func:`qa.gate` raises on the error rows."""
    return qa.with_status(qa.run_tests(_unique_tests(spark, d) + _doc_tests(spark, d)))


CUSTOMER_COLUMN_CHECKS = {
    "c_custkey": {"null_check": {"equal_to": 0}, "distinct_check": {"geq_to": 2}, "unique_check": {"equal_to": 0}},
    "c_mktsegment": {"null_check": {"equal_to": 0}, "distinct_check": {"geq_to": 2}},
    "c_nationkey": {"distinct_check": {"geq_to": 2}},
}


@register("qa_column_checks", """
SELECT 'c_custkey' AS "column", 'null_check' AS "check", count(*) - count(c_custkey) AS value,
       count(*) - count(c_custkey) = 0 AS passed FROM customer
UNION ALL SELECT 'c_custkey', 'distinct_check', count(DISTINCT c_custkey), count(DISTINCT c_custkey) >= 2 FROM customer
UNION ALL SELECT 'c_custkey', 'unique_check', count(c_custkey) - count(DISTINCT c_custkey),
       count(c_custkey) - count(DISTINCT c_custkey) = 0 FROM customer
UNION ALL SELECT 'c_mktsegment', 'null_check', count(*) - count(c_mktsegment), count(*) - count(c_mktsegment) = 0
       FROM customer
UNION ALL SELECT 'c_mktsegment', 'distinct_check', count(DISTINCT c_mktsegment), count(DISTINCT c_mktsegment) >= 2
       FROM customer
UNION ALL SELECT 'c_nationkey', 'distinct_check', count(DISTINCT c_nationkey), count(DISTINCT c_nationkey) >= 2
       FROM customer""")
def qa_column_checks(spark, d):
    return qa.column_checks(table(spark, d, "customer"), CUSTOMER_COLUMN_CHECKS)


@register("qa_table_checks", """
SELECT 'customer' AS "table", 'row_count_check' AS "check", count(*) AS value,
       count(*) BETWEEN 1 AND 1000000000 AS passed FROM customer
UNION ALL SELECT 'customer', 'min_rows_check', count(*), count(*) >= 1000 FROM customer
UNION ALL SELECT 'nation', 'row_count_check', count(*), count(*) BETWEEN 1 AND 1000000000 FROM nation
UNION ALL SELECT 'nation', 'min_rows_check', count(*), count(*) >= 10000 FROM nation""")
def qa_table_checks(spark, d):
    """The nation ``min_rows_check`` (>= 10000 on a 25-row table) fails by design."""
    return qa.table_checks(table(spark, d, "customer"), "customer", {
        "row_count_check": ("between", (1, 1_000_000_000)), "min_rows_check": ("geq_to", 1000)}).unionByName(
        qa.table_checks(table(spark, d, "nation"), "nation", {
            "row_count_check": ("between", (1, 1_000_000_000)), "min_rows_check": ("geq_to", 10000)}))


@register("qa_referential", with_views(" UNION ALL ".join([
    _t("lineitem_supplier_fk", None,
       "(SELECT 1 FROM lineitem l WHERE l_suppkey IS NOT NULL AND NOT EXISTS "
       "(SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey))"),
    _t("orders_customer_fk", None,
       "(SELECT 1 FROM orders o WHERE o_custkey IS NOT NULL AND NOT EXISTS "
       "(SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey))"),
    _t("flights_planes_fk", None,
       "(SELECT 1 FROM flights f WHERE tailnum IS NOT NULL AND NOT EXISTS "
       "(SELECT 1 FROM planes p WHERE p.tailnum = f.tailnum))"),
    _t("labels_documents_fk", None,
       "(SELECT 1 FROM labels l WHERE doc_id IS NOT NULL AND NOT EXISTS "
       "(SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id))"),
]), "flights", "planes"))
def qa_referential(spark, d):
    return qa.run_tests([
        qa.referential_test(table(spark, d, "lineitem"), "l_suppkey", table(spark, d, "supplier"), "s_suppkey",
                            "lineitem_supplier_fk"),
        qa.referential_test(table(spark, d, "orders"), "o_custkey", table(spark, d, "customer"), "c_custkey",
                            "orders_customer_fk"),
        qa.referential_test(flights_view(spark, d), "tailnum", planes(spark, d), "tailnum", "flights_planes_fk"),
        qa.referential_test(table(spark, d, "labels"), "doc_id", table(spark, d, "documents"), "doc_id",
                            "labels_documents_fk"),
    ])


def cleansed_documents(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "text")
    return qa.cleanse(docs, "text", '"', "source", 4)


_CLEANSED_SQL = ("SELECT doc_id, source, lang, CASE WHEN regexp_matches(text, '\"') "
                 "THEN regexp_replace(text, '\"', '', 'g') ELSE text END AS text FROM documents "
                 "WHERE NOT coalesce(length(source) != 4, false)")


@register("qa_cleanse", _CLEANSED_SQL)
def qa_cleanse(spark, d):
    return cleansed_documents(spark, d)


@register("qa_branch_cleanse", f"""
WITH cleansed AS ({_CLEANSED_SQL}),
before AS ({_LENGTH_SQL.format(docs="documents")} UNION ALL
           {_t("documents_text_quotes", _Q.format(c="text"), "documents", 10, 1000)}),
after AS ({_LENGTH_SQL.format(docs="cleansed")} UNION ALL
          {_t("documents_text_quotes", _Q.format(c="text"), "cleansed", 10, 1000)})
SELECT b.test, b.failures AS failures_before, 'cleansed' AS action, a.failures AS failures_after
FROM before b JOIN after a ON a.test = b.test""")
def qa_branch_cleanse(spark, d):
    """Branch on the tests: cleanse when any failure is found, otherwise leave the table as it is."""
    docs = table(spark, d, "documents")
    before = qa.run_tests(_doc_tests(spark, d, docs, with_pages=False))
    needs = qa.first_row_true(before.agg(F.max(F.col("failures") > 0)))
    target = cleansed_documents(spark, d) if needs else docs
    after = qa.run_tests(_doc_tests(spark, d, target, with_pages=False))
    b = before.select("test", F.col("failures").alias("failures_before"))
    a = after.select("test", F.col("failures").alias("failures_after"))
    return b.join(a, "test").select("test", "failures_before", F.lit("cleansed" if needs else "skipped").alias(
        "action"), "failures_after")


@register("qa_write_audit_publish", f"""
WITH cleansed AS ({_CLEANSED_SQL}),
audit AS ({_LENGTH_SQL.format(docs="cleansed")} UNION ALL
          {_t("documents_text_quotes", _Q.format(c="text"), "cleansed", 0, 0)})
SELECT *, CASE WHEN should_error THEN 'error' WHEN should_warn THEN 'warn' ELSE 'pass' END AS status,
       (SELECT count(*) FROM cleansed) AS published_rows
FROM audit""")
def qa_write_audit_publish(spark, d):
    """Cleanse on a branch folder, audit there (quotes must be gone entirely), then publish."""
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "text")
    published = qa.write_audit_publish(
        spark, docs, lambda df: qa.cleanse(df, "text", '"', "source", 4),
        lambda cand: qa.scan_tests(cand, _doc_rules(quote_levels=(0, 0))),
        "documents")
    n = published.read(spark).agg(F.count(F.lit(1)))
    return published.audit.withColumn("published_rows", n.scalar())


AS_OF = "2024-01-01 00:00:00"


def metrics_rows(results: DataFrame, database: str, as_of: str = AS_OF) -> DataFrame:
    """One metrics-log row per test result (ts, file_line, log_level, message, test_time, database, model)."""
    r = qa.with_status(results)
    return r.select(
        F.lit(as_of).alias("ts"),
        F.lit("contrail/plans/quality.py").alias("file_line"),
        F.upper(F.when(F.col("status") == "pass", "info").otherwise(F.col("status"))).alias("log_level"),
        F.concat("test", F.lit(": "), F.col("failures").cast("string"), F.lit(" failures")).alias("message"),
        F.to_date(F.lit(as_of)).alias("test_time"),
        F.lit(database).alias("database_tested"),
        F.col("test").alias("model_tested"),
    )


@register("qa_metrics_log", f"""
SELECT '{AS_OF}' AS ts, 'contrail/plans/quality.py' AS file_line,
       upper(CASE WHEN should_error THEN 'error' WHEN should_warn THEN 'warn' ELSE 'info' END) AS log_level,
       test || ': ' || CAST(failures AS VARCHAR) || ' failures' AS message, DATE '{AS_OF[:10]}' AS test_time,
       'testdata' AS database_tested, test AS model_tested
FROM ({_LENGTH_SQL.format(docs="documents")} UNION ALL {_QUOTE_SQL.format(docs="documents")})""")
def qa_metrics_log(spark, d):
    """Append one metrics row per check to an append-only log table, then read the log back."""
    log = scratch_path(spark, "qa-metrics-log")
    results = qa.run_tests(_doc_tests(spark, d))
    metrics_rows(results, "testdata").write.mode("append").parquet(log)
    return spark.read.parquet(log)
