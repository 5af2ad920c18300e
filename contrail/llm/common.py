"""Helpers shared by the training-data operators.

Text travels to Python tasks as UTF-8 bytes.  ``bytes.lower`` and
``bytes.split`` touch ASCII only, which is what the word rules of the
operators ask for (words are runs of bytes other than 0x20 and 0x09-0x0D).
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import contrail
from contrail.session import scratch_path

WORDS = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the package to the Python workers of this application, which need not share the driver's folders.

    Once per application; nothing to do when the package came from a file that Spark already ships.
    """
    sc, root = spark.sparkContext, os.path.dirname(os.path.abspath(contrail.__file__))
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    if os.path.isdir(root):
        path = os.path.join(tempfile.mkdtemp(prefix="contrail-code-"), "contrail.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage and survives lost executors."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    ship_code(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(text: Column) -> Column:
    """Text as bytes; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32(doc_id as text) mod ``mod``; a null id falls in the class of the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def py_remainder(doc_id: int | None, mod: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


def tidy() -> None:
    """Give freed memory back to the system at the end of a task: a Python worker outlives it and serves other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass


HOT_SHARE = 1000


def attach(rows: DataFrame, facts: DataFrame, key: str, count: str, spread: str, total: int) -> DataFrame:
    """Left join of ``rows`` with ``facts`` (one row per ``key``), safe for keys that hold a third of all rows.

    ``count`` in ``facts`` says how many of the ``total`` rows share a key.
    Keys with more than total/1000 rows number fewer than 1000, so they go by
    broadcast; all others go by a shuffle join in which rows already served
    are dealt by a hash of ``spread`` instead of by their hot key.  Callers
    pass ``facts`` as a written table, because it is read twice.
    """
    vals = [c for c in facts.columns if c not in (key, count)]
    is_hot = F.col(count) * HOT_SHARE > F.lit(int(total))
    packed = F.struct(*vals)
    hot = facts.filter(is_hot).select(F.col(key).alias("_hk"), packed.alias("_hot"))
    cold = facts.filter(~is_hot).select(F.col(key).alias("_ck"), F.lit(0).alias("_cs"), packed.alias("_cold"))
    left = rows.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left")
    away = F.col("_hot").isNotNull() | F.col(key).isNull()
    left = left.withColumn("_salt", F.when(away, 1 + F.pmod(F.xxhash64(F.col(spread)), F.lit(65536))).otherwise(F.lit(0)).cast("int"))
    both = left.join(cold, (F.col(key) == F.col("_ck")) & (F.col("_salt") == F.col("_cs")), "left")
    out = both.withColumn("_val", F.coalesce("_hot", "_cold"))
    return out.select(*rows.columns, *[F.col("_val")[v].alias(v) for v in vals])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has an edge.

    Alternating large-star / small-star contraction (Kiveris et al. 2014):
    logarithmically many rounds, each a pair of group-min and join steps over
    the remaining edges, written to the shared folder.
    """
    e = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s")).select("s.*")
        e = written(small.filter("u <> v").distinct(), "edges")
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    roots = e.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
