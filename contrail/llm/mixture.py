"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed 60-bit hash of its id.  A source that has to give
``target`` words gives ``target // source_size`` whole passes of itself plus
the documents whose hash lies below a threshold.  The threshold comes from
histograms: words are summed by source and by the next 12 hash bits, the bucket
in which the running sum crosses the budget is found, and only that bucket is
refined, until it holds a single hash.  Nothing is sorted and no document is
moved; smaller budgets take a subset of what larger ones take.

Cases: null or empty texts have size 0; a null source is a source of its own,
last in order; a null id hashes like the empty text; rows with the same id
share their hash and are taken together; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import WORDS, attach, written
from contrail.operators.joins import dim_join
from contrail.operators.ranking import dense_sequence

BITS, STEP = 60, 12
WEIGHTS = (5, 2, 1)


def _targets(stats: DataFrame, share: float, limit: float) -> DataFrame:
    """Weighted targets, none above ``limit`` times its source; only two numbers a round reach the driver.

    Each source wants rate * weight; sources whose limit is lower get their
    limit, and the rate rises until the capped set is stable.
    """
    cap = F.col("source_size") * F.lit(limit)
    sums = stats.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, rate, capped = (sums[0] or 0) * share, 0.0, -1
    rate = budget / sums[1] if sums[1] else 0.0
    while True:
        at = cap <= F.lit(rate) * F.col("weight")
        n, held, free = stats.agg(F.count(F.when(at, 1)), F.sum(F.when(at, cap)), F.sum(F.when(~at, F.col("weight")))).first()
        if n == capped:
            break
        capped = n
        if not free:
            break
        rate = (budget - (held or 0)) / free
    return stats.withColumn("target", F.least(cap, F.lit(rate) * F.col("weight")))


def _key() -> Column:
    return F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), "source"))


def _hash() -> Column:
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def plan_mix(docs: DataFrame, share: float = 1.5, limit: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame, int]:
    """(sizes of the documents, what each source gives, number of documents)."""
    text_size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    sized = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key().alias("skey"), text_size.alias("size"), _hash().alias("h")), "sizes")
    stats = sized.groupBy("skey").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ranked = dense_sequence(stats, ["skey"], "rank")  # UTF-8 byte order is code point order
    turn = F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1
    weighted = written(ranked.select("skey", "source_size", "n", F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int")).alias("weight")), "sources")
    total = weighted.agg(F.sum("n")).first()[0] or 0
    goal = _targets(weighted, share, limit)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = written(goal.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
                    .withColumn("below", F.lit(0).cast("long")).withColumn("prefix", F.lit(0).cast("long")), "budgets")

    bits = 0
    while bits < BITS:
        inside = attach(sized, state.select("skey", "n", "prefix"), "skey", "n", "doc_id", total)
        if bits:
            inside = inside.filter(F.shiftright("h", BITS - bits) == F.col("prefix"))
        bits += STEP
        hist = written(inside.groupBy("skey", F.shiftright("h", BITS - bits).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi")), "histogram")
        run = Window.partitionBy("skey").orderBy("bucket")  # at most 4096 buckets a source
        hist = hist.withColumn("upto", F.sum("words").over(run)).join(state.select("skey", "rest", F.col("below").alias("was")), "skey")
        # The boundary bucket: the first whose running sum passes the budget.
        over = F.col("was") + F.col("upto") > F.col("rest")
        edge = hist.filter(over).groupBy("skey").agg(F.min(F.struct("bucket", "upto", "words", "lo", "hi", "was")).alias("e"))
        edge = edge.select("skey", F.col("e.bucket").alias("to"), (F.col("e.was") + F.col("e.upto") - F.col("e.words")).alias("sum"),
                           (F.col("e.lo") < F.col("e.hi")).alias("more"), F.col("e.lo").alias("lo"), F.col("e.words").alias("words"))
        state = written(state.select("skey", "source_size", "n", "weight", "target", "passes", "rest").join(edge, "skey", "left")
                        .withColumn("prefix", F.coalesce("to", F.lit(-1).cast("long")))  # -1: no bucket passes it, all are taken
                        .withColumn("below", F.coalesce("sum", F.lit(0).cast("long"))).drop("to", "sum"), "budgets")
        if not state.filter("more").limit(1).count():
            break
    # The hash at the boundary is taken when that brings the sum nearer to the budget.
    near = (F.col("rest") - F.col("below")) * 2 >= F.col("words")
    cut = F.when(F.col("prefix") < 0, F.lit(1 << BITS)).otherwise(F.col("lo") + F.when(near, F.lit(1)).otherwise(F.lit(0)))
    return sized, written(state.select("skey", "n", "source_size", "target", "passes", cut.cast("long").alias("cut")), "cuts"), total


def _copies(limit: float) -> Column:
    """How often the mix takes a document; a source at its limit takes whole passes only."""
    return F.least((F.col("passes") + (F.col("h") < F.col("cut")).cast("int")).cast("int"), F.lit(int(limit)))


def mix(docs: DataFrame, share: float = 1.5, limit: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies and taken (words, repeats counted)."""
    sized, facts, total = plan_mix(docs, share, limit, weights)
    out = attach(sized, facts, "skey", "n", "doc_id", total).withColumn("copies", _copies(limit))
    return out.withColumn("taken", F.col("size") * F.col("copies")).drop("skey", "h", "passes", "cut")


def mixed_documents(docs: DataFrame, share: float = 1.5, limit: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The documents of the mix, each row as often as the mix takes it, with the columns of ``docs``."""
    _, facts, _ = plan_mix(docs, share, limit, weights)
    facts = facts.select(F.col("skey").alias("__key"), "passes", "cut")
    names = [f"__{i}" for i in range(len(docs.columns))]  # keep clear of the columns of the plan
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names)], _key().alias("__key"), _hash().alias("h"))
    took = dim_join(rows, facts, "__key").withColumn("__copies", _copies(limit)).filter("__copies > 0")
    took = took.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return took.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])
