"""Parquet base tables and the airline star schema derived from them.

The test tables are TPC-H shaped; the airline model maps onto them as:

* airlines  <- supplier  (code = s_suppkey, description = s_name)
* airports  <- nation    (iata = n_nationkey, airport = city = n_name, country = n_regionkey)
* planes    <- part      (tailnum = p_partkey, model = manufacturer = p_brand, engine_type = p_type)
* flights   <- lineitem joined with orders, customer and supplier (``flights`` below)

All of it is plain DataFrame code, so column pruning and filters reach the
parquet scans and Catalyst picks the join strategy.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.joins import dim_join
from contrail.session import scratch_path, shuffle_width

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


_TABLE_CACHE: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``name`` under ``sf_dir``.

    The DataFrame (a plan, not data) is reused within one application so the
    file listing and footer read happen once per table.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _TABLE_CACHE.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _TABLE_CACHE[key] = df
    return df


def register_base_views(spark: SparkSession, sf_dir: str) -> None:
    for name in BASE_TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def register_star_views(spark: SparkSession, sf_dir: str, suffix: str = "") -> list[str]:
    """Temp views ``flights``, ``airlines``, ``airports``, ``planes`` (+ ``suffix``) so lab SQL runs as written."""
    views = {"flights": flights(spark, sf_dir), "airlines": airlines(spark, sf_dir),
             "airports": airports(spark, sf_dir), "planes": planes(spark, sf_dir)}
    for name, df in views.items():
        df.createOrReplaceTempView(name + suffix)
    return [n + suffix for n in views]


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").cast("int").alias("code"), F.col("s_name").alias("description"))


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").alias("iata"),
        F.col("n_name").alias("airport"),
        F.col("n_name").alias("city"),
        F.col("n_regionkey").alias("country"),
    )


def planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("tailnum"),
        F.col("p_brand").alias("manufacturer"),
        F.col("p_brand").alias("model"),
        F.col("p_type").alias("engine_type"),
        F.col("p_size").alias("year"),
    )


def _null_on_line7(expr: Column) -> Column:
    return F.when(F.col("l_linenumber") != 7, expr)


FLIGHT_COLUMNS = [
    "year", "month", "dayofmonth", "deptime", "uniquecarrier", "flightnum", "tailnum", "depdelay", "arrdelay",
    "origin", "dest", "distance", "cancelled", "cancellationcode", "dayofweek", "arrtime", "taxiin", "taxiout",
    "airtime", "actualelapsedtime", "weatherdelay", "nasdelay", "securitydelay", "lateaircraftdelay",
]
JOIN_ROWS = 500_000  # lineitem rows for each shuffle partition of the fact's join
_FACTS: dict[tuple[str, str, str], tuple[str, DataFrame]] = {}


def flights(spark: SparkSession, sf_dir: str, materialize: bool | None = None) -> DataFrame:
    """The flights fact, materialised once per application as a (year, month)-partitioned Parquet table.

    Like the labs' CTAS into a partitioned columnar table: the four-way join
    runs once, later queries read the table with partition and column pruning.
    The rows are range-partitioned on (year, month, hash salt) before the
    write, so each writer covers a narrow slice of months and a month holding
    a third of all rows is still split over many writers.  Only base columns
    travel; a writer makes the others.  The table lives
    under the shared checkpoint folder.  ``contrail.flights.materialize=false``
    (or ``materialize=False``) returns the plain join plan instead.  With
    ``contrail.fact.dir`` set to a shared folder the table is built there once
    and reused by later applications (a completion marker is written last).
    """
    if materialize is None:
        materialize = spark.conf.get("contrail.flights.materialize", "true").lower() == "true"
    if not materialize:
        return flights_plan(spark, sf_dir)
    # Keyed by application and folder: the input tables are read-only while an application runs.
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), spark.conf.get("contrail.fact.dir", ""))
    hit = _FACTS.get(key)
    if hit is not None and hit[1].sparkSession is not spark:
        hit = None
    if hit is None:
        plan = flights_plan(spark, sf_dir)
        fact_dir = spark.conf.get("contrail.fact.dir", None)
        if fact_dir:
            path = f"{fact_dir.rstrip('/')}/flights-{_fingerprint(spark, sf_dir)}"
            if _complete(spark, path):
                hit = (path, spark.read.schema(plan.schema).parquet(path).select(*FLIGHT_COLUMNS))
                _FACTS[key] = hit
                return hit[1]
        else:
            path = scratch_path(spark, "flights-fact")
        # As many writers as the fact's input has splits (at least the shuffle width): each
        # writer then holds about one input split's worth of rows.
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                table(spark, sf_dir, "lineitem").rdd.getNumPartitions())
        from contrail.operators.tables import write_range_partitioned

        months = table(spark, sf_dir, "lineitem").select(*_period(F.col("l_shipdate").cast("date")))
        with shuffle_width(spark, table(spark, sf_dir, "lineitem").count() // JOIN_ROWS + 1):
            write_range_partitioned(_flight_base(spark, sf_dir), path, ["year", "month"], ["l_orderkey", "l_partkey", "l_linenumber", "distance"],
                                    n, months, _flight_columns)
        _mark_complete(spark, path)
        # One DataFrame per table: the file listing is done once and reused by every query.
        hit = (path, spark.read.schema(plan.schema).parquet(path).select(*FLIGHT_COLUMNS))
        _FACTS[key] = hit
    return hit[1]


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Of the fact's input files: path, length and time of each.  Changed input gets a folder of its own."""
    jvm, seen = spark.sparkContext._jvm, []
    for t in ("lineitem", "orders", "customer", "supplier"):
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
        while files.hasNext():
            f = files.next()
            seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:20]


def fact_fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Changes when an input file of the fact does."""
    return _fingerprint(spark, sf_dir)


_MARKER = "_CONTRAIL_COMPLETE"


def _marker(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{_MARKER}")
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _complete(spark: SparkSession, path: str) -> bool:
    p, fs = _marker(spark, path)
    return bool(fs.exists(p))


def _mark_complete(spark: SparkSession, path: str) -> None:
    """Written after the table's files are committed: readers trust the folder only with this marker."""
    p, fs = _marker(spark, path)
    fs.create(p, True).close()


def flights_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table as a plan: one flight per lineitem row.

    orders and customer grow with the fact, so those joins stay shuffle joins
    unless adaptive execution sees a small side at run time; supplier is a
    dimension and goes through the size-checked broadcast.
    """
    return _flight_columns(_flight_base(spark, sf_dir))


def _period(day: Column) -> list[Column]:
    return [F.year(day).cast("int").alias("year"), F.month(day).cast("int").alias("month")]


def _flight_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period and base columns of every flight, from which :func:`_flight_columns` makes the others."""
    li = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    # orders ⨝ customer first (orders-sized), then one lineitem-sized join on the order key:
    # the lineitem rows are shuffled once for orders instead of twice (orderkey, then custkey).
    dest = dim_join(orders, customer, orders.o_custkey == customer.c_custkey).select("o_orderkey", "c_nationkey")
    j = li.join(dest, li.l_orderkey == dest.o_orderkey)
    j = dim_join(j, supplier, j.l_suppkey == supplier.s_suppkey)
    return j.select(*_period(F.col("l_shipdate")), "l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
                    "s_nationkey", "c_nationkey", F.col("l_quantity").cast("int").alias("qty"),
                    F.floor(F.col("l_extendedprice") / 100).cast("int").alias("distance"))


def _flight_columns(base: DataFrame) -> DataFrame:
    qty = F.col("qty")
    return base.select(
        "year",
        "month",
        F.dayofmonth("l_shipdate").cast("int").alias("dayofmonth"),
        ((F.col("l_orderkey") % 24) * 100 + (F.col("l_partkey") % 60)).cast("int").alias("deptime"),
        F.col("l_suppkey").cast("int").alias("uniquecarrier"),
        (F.col("l_orderkey") % 1000).cast("int").alias("flightnum"),
        F.col("l_partkey").alias("tailnum"),
        _null_on_line7(qty - 20).alias("depdelay"),
        _null_on_line7(qty - 22 + F.col("l_linenumber")).alias("arrdelay"),
        F.col("s_nationkey").alias("origin"),
        F.col("c_nationkey").alias("dest"),
        "distance",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("cancelled"),
        F.when(F.col("l_returnflag") == "R", F.col("l_linestatus")).alias("cancellationcode"),
        (F.weekday("l_shipdate") + 1).cast("int").alias("dayofweek"),
        ((F.col("l_orderkey") % 24) * 100 + (F.col("l_partkey") % 60) + F.col("l_linenumber") * 41)
        .cast("int").alias("arrtime"),
        (F.col("l_suppkey") % 13 + 2).cast("int").alias("taxiin"),
        (F.col("l_linenumber") * 4 + F.col("l_partkey") % 11).cast("int").alias("taxiout"),
        (F.col("l_partkey") % 300 + 30).cast("int").alias("airtime"),
        ((F.col("l_partkey") % 300 + 30) + (F.col("l_suppkey") % 13 + 2)
         + (F.col("l_linenumber") * 4 + F.col("l_partkey") % 11)).cast("int").alias("actualelapsedtime"),
        F.when(F.col("l_returnflag") == "A", qty % 10).alias("weatherdelay"),
        F.when(F.col("l_linestatus") == "O", F.col("l_linenumber") * 2).alias("nasdelay"),
        (F.col("l_orderkey") % 3).cast("int").alias("securitydelay"),
        _null_on_line7((F.col("l_partkey") % 17).cast("int")).alias("lateaircraftdelay"),
    )


# The same fact as SQL text, for DuckDB oracles (only base tables are registered there).
FLIGHTS_SQL = """
SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
       CAST(day(l_shipdate) AS INT) AS dayofmonth,
       CAST((l_orderkey % 24) * 100 + (l_partkey % 60) AS INT) AS deptime,
       CAST(l_suppkey AS INT) AS uniquecarrier, CAST(l_orderkey % 1000 AS INT) AS flightnum, l_partkey AS tailnum,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS INT) - 20 END AS depdelay,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS INT) - 22 + l_linenumber END AS arrdelay,
       s_nationkey AS origin, c_nationkey AS dest, CAST(floor(l_extendedprice / 100) AS INT) AS distance,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS cancelled,
       CASE WHEN l_returnflag = 'R' THEN l_linestatus END AS cancellationcode,
       CAST(isodow(l_shipdate) AS INT) AS dayofweek,
       CAST((l_orderkey % 24) * 100 + (l_partkey % 60) + l_linenumber * 41 AS INT) AS arrtime,
       CAST(l_suppkey % 13 + 2 AS INT) AS taxiin,
       CAST(l_linenumber * 4 + l_partkey % 11 AS INT) AS taxiout,
       CAST(l_partkey % 300 + 30 AS INT) AS airtime,
       CAST((l_partkey % 300 + 30) + (l_suppkey % 13 + 2) + (l_linenumber * 4 + l_partkey % 11) AS INT)
         AS actualelapsedtime,
       CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS INT) % 10 END AS weatherdelay,
       CASE WHEN l_linestatus = 'O' THEN l_linenumber * 2 END AS nasdelay,
       CAST(l_orderkey % 3 AS INT) AS securitydelay,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_partkey % 17 AS INT) END AS lateaircraftdelay
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
"""

AIRLINES_SQL = "SELECT CAST(s_suppkey AS INT) AS code, s_name AS description FROM supplier"
AIRPORTS_SQL = ("SELECT n_nationkey AS iata, n_name AS airport, n_name AS city, n_regionkey AS country "
                "FROM nation")
PLANES_SQL = ("SELECT p_partkey AS tailnum, p_brand AS manufacturer, p_brand AS model, p_type AS engine_type, "
              "p_size AS year FROM part")

_VIEW_SQL = {"flights": FLIGHTS_SQL, "airlines": AIRLINES_SQL, "airports": AIRPORTS_SQL, "planes": PLANES_SQL}


def with_views(body: str, *views: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with CTEs for the named star-schema views (+ extra CTEs, in order)."""
    parts = [f"{v} AS ({_VIEW_SQL[v]})" for v in views]
    for name, sql in (extra or {}).items():
        parts.append(f"{name} AS ({sql})")
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
