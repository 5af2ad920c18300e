"""Delimited-text sources: declared schema, inferred schema, custom dialects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_fixed(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",",
               quoting: bool = False) -> DataFrame:
    """Declared schema, header line skipped.

    ``quoting=False`` reads every character literally (quotes stay in the data
    and an embedded separator splits the field), like a plain text table.
    Fields that do not convert to their type become NULL; extra fields are dropped.
    """
    reader = spark.read.schema(schema).option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
    if not quoting:
        reader = reader.option("quote", "")
    return reader.csv(path)


LINE = "_line"


def read_with_rejects(spark: SparkSession, path: str, schema: str, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected lines): every line below a header is in exactly one of them.

    Nothing is quoted.  A line is rejected when its number of fields is wrong or a
    field that is not empty does not convert to its type.  A rejected line is kept
    as it was read, with its ``file`` and a ``reason``: ``fields`` or the name of the first bad column.
    """
    fields = T._parse_datatype_string(schema).fields
    text = [T.StructField(f.name, T.StringType()) for f in fields]
    # Without column pruning the reader looks at whole lines, whatever columns a query needs.
    raw = (spark.read.schema(T.StructType([*text, T.StructField(LINE, T.StringType())])).option("header", True).option("sep", sep).option("quote", "")
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).option("columnPruning", False).csv(path).withColumn("file", F.col("_metadata.file_name")))
    bad = F.coalesce(*[F.when((F.col(f.name) != "") & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name)) for f in fields if f.dataType != T.StringType()],
                     F.lit(None).cast("string"))
    reason = F.when(F.col(LINE).isNotNull(), F.lit("fields")).otherwise(bad)  # the reader marks lines with too few or too many fields
    judged = raw.withColumn("reason", reason)
    line = F.coalesce(F.col(LINE), F.concat_ws(sep, *[F.coalesce(F.col(f.name), F.lit("")) for f in fields]))
    accepted = judged.where("reason is null").select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields])
    return accepted, judged.where("reason is not null").select("file", "reason", line.alias("line"))


def write_quarantine(rejects: DataFrame, path: str) -> None:
    """Rejected lines as a table by reason, so that one kind can be looked at or sent again."""
    rejects.write.mode("append").partitionBy("reason").parquet(path)


def read_inferred(spark: SparkSession, path: str, pin: dict[str, str] | None = None) -> DataFrame:
    """Header + inferred types; ``pin`` then fixes the types so later files cannot drift them."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    if pin:
        df = df.select(*[F.col(c).cast(pin[c]).alias(c) if c in pin else F.col(c) for c in df.columns])
    return df


def read_dialect(spark: SparkSession, path: str, schema: str | T.StructType, sep: str, quote: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("quote", quote).csv(path)


def write_dialect(df: DataFrame, path: str, sep: str, quote: str) -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("quote", quote).csv(path)


def write_raw_lines(lines: DataFrame, header: str, path: str) -> None:
    """Write pre-built text lines (column ``line``) with ``header`` atop every file, nothing quoted."""
    (lines.select(F.col("line").alias(header)).write.mode("overwrite")
     .option("header", True).option("sep", "\u0001").option("quote", "").option("escapeQuotes", False).csv(path))
