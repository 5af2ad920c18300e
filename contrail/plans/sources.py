"""Source queries: delimited text written by Spark from the given tables, then scanned back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail.plans.registry import register
from contrail.session import scratch_path
from contrail.sources import delimited as dl
from contrail.sources.tables import flights, table, with_views

# Part rows become a plain-text "planes" file: large sizes get a quoted name, tiny sizes a quoted
# name with an embedded comma -- both are read literally by the no-quote scan.
_NAME_TEXT_SQL = ("CASE WHEN p_size > 45 THEN '\"' || p_name || '\"' "
                  "WHEN p_size < 3 THEN '\"' || p_name || ', deluxe\"' ELSE p_name END")


def _name_text():
    q = F.lit('"')
    return (F.when(F.col("p_size") > 45, F.concat(q, "p_name", q))
            .when(F.col("p_size") < 3, F.concat(q, "p_name", F.lit(", deluxe"), q)).otherwise(F.col("p_name")))


@register("scan_csv_fixed", f"""
WITH l AS (SELECT string_split(CAST(p_partkey AS VARCHAR) || ',' || {_NAME_TEXT_SQL} || ',' || p_brand || ','
                  || CAST(p_size AS VARCHAR), ',') AS p FROM part)
SELECT TRY_CAST(p[1] AS BIGINT) AS p_partkey, p[2] AS p_name, p[3] AS p_brand, TRY_CAST(p[4] AS INTEGER) AS p_size
FROM l""")
def scan_csv_fixed(spark, d):
    part = table(spark, d, "part")
    line = F.concat_ws(",", F.col("p_partkey").cast("string"), _name_text(), "p_brand", F.col("p_size").cast("string"))
    path = scratch_path(spark, "planes-csv")
    dl.write_raw_lines(part.select(line.alias("line")), "p_partkey,p_name,p_brand,p_size", path)
    return dl.read_fixed(spark, path, "p_partkey long, p_name string, p_brand string, p_size int")


_INFER_COLS = ["year", "month", "dayofmonth", "uniquecarrier", "flightnum", "tailnum", "depdelay", "cancellationcode"]
_PIN = {"year": "int", "month": "int", "dayofmonth": "int", "uniquecarrier": "int", "flightnum": "int",
        "tailnum": "bigint", "depdelay": "int", "cancellationcode": "string"}


@register("scan_csv_inferred", with_views(f"SELECT {', '.join(_INFER_COLS)} FROM flights", "flights"))
def scan_csv_inferred(spark, d):
    path = scratch_path(spark, "flights-csv")
    flights(spark, d).select(*_INFER_COLS).write.mode("overwrite").option("header", True).csv(path)
    return dl.read_inferred(spark, path, _PIN)


@register("scan_csv_dialect", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_dialect(spark, d):
    path = scratch_path(spark, "customer-psv")
    dl.write_dialect(table(spark, d, "customer"), path, sep="|", quote="'")
    return dl.read_dialect(spark, path, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                                        "c_mktsegment string", sep="|", quote="'")


_REJECT_SQL = "CASE WHEN p_partkey % 97 = 0 THEN 'p_size' WHEN p_partkey % 89 = 0 THEN 'p_partkey' WHEN p_partkey % 83 = 0 OR p_partkey % 79 = 0 THEN 'fields' END"


@register("scan_csv_rejects", f"""
WITH l AS (SELECT *, {_REJECT_SQL} AS reason FROM part)
SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS n_lines, CAST(sum(CASE WHEN reason IS NULL THEN p_size END) AS BIGINT) AS sum_size,
       (SELECT count(*) FROM part) AS n_in_file FROM l GROUP BY 1""")
def scan_csv_rejects(spark, d):
    """Lines with a bad number or a wrong number of fields go to a quarantine table; accepted and rejected lines make up the file."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    line = (F.when(key % 97 == 0, F.concat_ws(",", key.cast("string"), "p_brand", F.concat(F.lit("x"), size)))
            .when(key % 89 == 0, F.concat_ws(",", F.concat(key.cast("string"), F.lit("?")), "p_brand", size))
            .when(key % 83 == 0, F.concat_ws(",", key.cast("string"), "p_brand"))
            .when(key % 79 == 0, F.concat_ws(",", key.cast("string"), "p_brand", size, F.lit("more")))
            .otherwise(F.concat_ws(",", key.cast("string"), "p_brand", size)))
    path, quarantine = scratch_path(spark, "parts-csv"), scratch_path(spark, "parts-rejected")
    dl.write_raw_lines(table(spark, d, "part").select(line.alias("line")), "p_partkey,p_brand,p_size", path)
    accepted, rejects = dl.read_with_rejects(spark, path, "p_partkey long, p_brand string, p_size int")
    dl.write_quarantine(rejects, quarantine)
    kept = spark.read.schema("file string, line string, reason string").parquet(quarantine)
    good = accepted.agg(F.lit("accepted").alias("outcome"), F.count(F.lit(1)).alias("n_lines"), F.sum("p_size").alias("sum_size"))
    bad = kept.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n_lines"), F.lit(None).cast("long").alias("sum_size"))
    both = good.unionByName(bad)
    return both.withColumn("n_in_file", F.sum("n_lines").over(Window.partitionBy()))  # a handful of rows
