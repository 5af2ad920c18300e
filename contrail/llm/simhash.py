"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints: words are lower-cased (ASCII) and joined to shingles; bit b of
the 64-bit fingerprint is set when more than half of the shingles' XXH64 values
have it set.

Search: the 64 bits are grouped into two parts of 32 so that correlated bits
share a part.  If two fingerprints differ in at most ``distance`` bits, then for
any thresholds t1, t2 >= -1 with (t1 + 1) + (t2 + 1) = distance + 1 some part
differs in at most its threshold.  Thresholds are chosen for every fingerprint
by dynamic programming on estimated candidate counts (from histograms of the
16-bit halves of each part).  A fingerprint probes every value within its
threshold; an equi-join of probes with indexed part values finds the
candidates, which are verified on all 64 bits.

Keys that very many fingerprints share are not joined pairwise: their members
are dealt again by the bytes of the other part (two members within 3 bits agree
in at least one of 4 bytes), cut into blocks, and each block pair returns only
the edges of a spanning forest, which joins the same components.

Cases: no words gives fingerprint zero, linked like any other; null text is
empty; rows with a null id take part, and a component's id is its smallest
non-null id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import attach, components, ship_code, tidy, utf8, written

PARTS, WIDTH = 2, 32
DISTANCE = 3
KEY_LIMIT = 64  # members of a key that are joined directly
BLOCK = 2048  # members of a block of a larger key
PROBE_COST = 1.0  # one probe costs about as much as one candidate
_XXH = functools.partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    h = np.fromiter(map(_XXH, grams), np.uint64, n)
    set_ = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = h[at : at + (1 << 16)].astype("<u8")
        set_ += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(set_ * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every row."""
    ship_code(docs.sparkSession)
    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column("t")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])
        tidy()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("t"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(nodes: DataFrame) -> list[list[int]]:
    """Bit positions of each part: greedily the bits most correlated with those already in the part."""
    ship_code(nodes.sparkSession)
    def partial(batches):
        both = np.zeros((64, 64))
        for batch in batches:
            x = _bits(batch.column("fp").to_numpy()).astype(np.float32)
            both += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096)), pa.array(both.ravel().astype(np.int64))], names=["cell", "n"])

    n = nodes.count()
    both = np.zeros(4096)
    for r in nodes.select("fp").mapInArrow(partial, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        both[r["cell"]] = r["n"]
    both = both.reshape(64, 64) / max(n, 1)
    p = np.diag(both)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, parts = list(range(64)), []
    for _ in range(PARTS):
        part = [max(left, key=lambda b: (corr[b, left].max(), -b))]
        left.remove(part[0])
        while len(part) < WIDTH:
            part.append(max(left, key=lambda b: (corr[b, part].mean(), -b)))
            left.remove(part[-1])
        parts.append(part)
    return parts


def part_values(fp: np.ndarray, parts: list[list[int]]) -> np.ndarray:
    """[n, parts] of 32-bit part values."""
    bits = _bits(fp)
    return np.stack([np.ascontiguousarray(np.packbits(bits[:, p], axis=1, bitorder="little")).view("<u4")[:, 0] for p in parts], 1).astype(np.int64)


def _shells(hist: np.ndarray, upto: int) -> np.ndarray:
    """[distance, value]: how many counted values lie exactly so far away, over 16-bit values."""
    flips = [np.arange(1 << 16) ^ (1 << j) for j in range(16)]
    around = lambda h: sum(h[f] for f in flips)
    shells = [hist, around(hist)]
    for d in range(2, upto + 1):
        shells.append((around(shells[-1]) - (16 - d + 2) * shells[-2]) / d)
    return np.stack(shells[: upto + 1])


def estimates(nodes: DataFrame, parts: list[list[int]], distance: int) -> np.ndarray:
    """[part, half, distance, value]: shell counts of the 16-bit halves; 4 x 65536 histogram cells at most."""
    def halves(batches):
        for batch in batches:
            v = part_values(batch.column("fp").to_numpy(), parts)
            cells = np.concatenate([((2 * i + h) << 16) + ((v[:, i] >> 16 * h) & 0xFFFF) for i in range(PARTS) for h in (0, 1)])
            cell, n = np.unique(cells, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], names=["cell", "n"])

    hist = np.zeros(4 << 16)
    got = nodes.select("fp").mapInArrow(halves, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    hist[got["cell"].to_numpy(np.int64)] = got["n"]
    return np.stack([_shells(h, distance) for h in hist.reshape(4, -1)]).reshape(PARTS, 2, distance + 1, -1).astype(np.float32)


def _ball(radius: int) -> np.ndarray:
    """All 32-bit masks with at most ``radius`` bits."""
    masks = [np.zeros(1, np.int64)]
    single = 1 << np.arange(WIDTH, dtype=np.int64)
    for _ in range(radius):
        masks.append(np.unique((masks[-1][:, None] | single).ravel()))
    return np.unique(np.concatenate(masks))


def allocate(values: np.ndarray, shells: np.ndarray, total: float, distance: int) -> np.ndarray:
    """[n, parts] thresholds (-1: part not probed) that minimise probes plus estimated candidates."""
    n, sizes = len(values), [len(_ball(r)) for r in range(distance + 1)]
    cost = np.zeros((PARTS, distance + 2, n))  # of threshold t at index t + 1
    for i in range(PARTS):
        lo, hi = shells[i, 0][:, values[:, i] & 0xFFFF], shells[i, 1][:, values[:, i] >> 16]
        found = np.zeros(n)
        for t in range(distance + 1):
            found = found + sum(lo[a] * hi[t - a] for a in range(t + 1)) / max(total, 1)
            cost[i, t + 1] = PROBE_COST * sizes[t] + found
    best, choice = cost[0], []
    for i in range(1, PARTS):  # best[s]: cheapest way to spend s = sum of (threshold + 1) on the parts so far
        ways = np.stack([np.stack([best[s - x] + cost[i, x] if s >= x else np.full(n, np.inf) for x in range(distance + 2)]) for s in range(distance + 2)])
        choice.append(ways.argmin(1))
        best = ways.min(1)
    out, s = np.zeros((n, PARTS), np.int64), np.full(n, distance + 1)
    for i in range(PARTS - 1, 0, -1):
        out[:, i] = choice[i - 1][s, np.arange(n)]
        s = s - out[:, i]
    out[:, 0] = s
    return out - 1


def _probes(parts, shells, total, distance):
    balls = [_ball(r) for r in range(distance + 1)]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column("fp").to_numpy()[at : at + 4096]
                values = part_values(fp, parts)
                chosen = allocate(values, shells, total, distance)
                for i in range(PARTS):
                    for t in range(distance + 1):
                        at_t = np.flatnonzero(chosen[:, i] == t)
                        for some in np.array_split(at_t, max(1, len(at_t) * len(balls[t]) >> 18)):
                            if len(some):
                                keys = (values[some, i][:, None] ^ balls[t]) | (i << WIDTH)
                                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(fp[some], len(balls[t])))], names=["key", "fp"])
    return run


def _index(parts):
    def run(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            values = part_values(fp, parts)
            for i in range(PARTS):
                yield pa.RecordBatch.from_arrays([pa.array(values[:, i] | (i << WIDTH)), pa.array(fp)], names=["key", "fp"])
    return run


def _resplit(parts):
    """Members of a large key, dealt by each byte of the other part."""
    def run(batches):
        for batch in batches:
            key, fp = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
            values = part_values(fp, parts)
            other = values[np.arange(len(fp)), 1 - (key >> WIDTH)]
            for j in range(4):
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(((other >> 8 * j) & 255) | j << 8), pa.array(fp)], names=["key", "sub", "fp"])
    return run


def forest(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among a block's fingerprints."""
    left, a, b = fp.view(np.uint64).copy(), [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= distance
            if near.any():
                got = left[near]
                left = left[~near]
                a += [x] * len(got)
                b += got.tolist()
                front += list(got)
    return np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64)


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints: every link of small keys, a spanning forest of large ones."""
    ship_code(nodes.sparkSession)
    parts = group_bits(nodes)
    total = float(nodes.count())
    shells = estimates(nodes, parts, distance)
    index = written(nodes.select("fp").mapInArrow(_index(parts), "key long, fp long"), "index")
    sizes = index.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    probes = nodes.select("fp").mapInArrow(_probes(parts, shells, total, distance), "key long, fp long")
    # Keys whose only member probes itself meet nobody else; the others are few.
    hits = written(probes.join(sizes, "key").join(
        index.groupBy("key").agg(F.min("fp").alias("one")), "key").filter("members > 1 or fp <> one").select("key", "fp", "members"), "hits")

    small = hits.filter(F.col("members") <= KEY_LIMIT).withColumnRenamed("fp", "a").join(index.withColumnRenamed("fp", "b"), "key")
    direct = small.filter(F.col("a") != F.col("b")).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).select("a", "b")

    large = hits.filter(F.col("members") > KEY_LIMIT).select("key").distinct()
    inside = index.join(large, "key").select("key", "fp").union(hits.filter(F.col("members") > KEY_LIMIT).select("key", "fp")).distinct()
    dealt = written(inside.mapInArrow(_resplit(parts), "key long, sub long, fp long"), "large")
    counts = dealt.groupBy("key", "sub").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Blocks of at most about BLOCK members; every pair of blocks meets in a group of its own.
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int")
    pairs = dealt.join(counts.withColumn("nb", blocks), ["key", "sub"]).withColumn("own", own)
    pairs = pairs.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    pairs = pairs.filter("nb = 1 or own <> with").select("key", "sub", F.least("own", "with").alias("lo"), F.greatest("own", "with").alias("hi"), "fp")

    def block_forest(group):
        a, b = forest(group.column("fp").to_numpy(), distance)
        return pa.table({"a": a, "b": b})

    bulk = pairs.groupBy("key", "sub", "lo", "hi").applyInArrow(block_forest, "a long, b long")
    return written(direct.unionByName(bulk).distinct(), "links")


def _members(docs: DataFrame, shingle: int, distance: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: doc_id, fp, component_id and root, a fingerprint that names the component."""
    if not 0 <= distance <= 3:
        raise ValueError("the byte split of large keys covers distances up to 3")
    fps = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")), "nodes")
    roots = components(links(nodes, distance)).withColumnRenamed("node", "fp")
    named = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    facts = written(named.select("fp", "n", "root").join(lowest, "root").select("fp", "n", "component_id", "root"), "components")
    total = facts.agg(F.sum("n")).first()[0] or 0
    return attach(fps.withColumnRenamed("fp", "key_fp"), facts.withColumnRenamed("fp", "key_fp"), "key_fp", "n", "doc_id", total).withColumnRenamed("key_fp", "fp")


def simhash_components(docs: DataFrame, shingle: int = 3, distance: int = DISTANCE,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fp, component_id (smallest id reachable over links of ``distance`` bits)."""
    return _members(docs, shingle, distance, id_col, text_col).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` for each component, that with its smallest id; all columns kept.

    An id may stand at several texts: of the rows that hold a component's smallest id, the one
    with the least fingerprint, then SHA-256 of the text, then of the row as JSON stays.
    Rows with a null id stay (they name no other row).
    """
    members = written(_members(docs, shingle, distance, "doc_id", "text").filter("doc_id is not null"), "members")
    least = members.filter("doc_id = component_id").select(F.col("doc_id").alias("__sim_id"), F.col("fp").alias("__sim_fp"), "root")
    often = members.groupBy(F.col("doc_id").alias("__sim_id")).agg(F.count(F.lit(1)).alias("__sim_n")).filter("__sim_n > 1")
    once = least.select("__sim_id").distinct().join(often, "__sim_id", "left_anti")
    known = F.col("doc_id").cast("long") == F.col("__sim_id")
    kept = docs.join(once, known, "left_semi").unionByName(docs.filter("doc_id is null"))
    if not often.limit(1).count():
        return kept
    # Ids that stand at several rows: fingerprints tell the rows apart.
    rows = _with_fingerprint(docs.join(often.select("__sim_id"), known, "left_semi"), shingle)
    same = (F.col("doc_id").cast("long") == F.col("__sim_id")) & (F.col("__fp") == F.col("__sim_fp"))
    met = rows.join(least.distinct(), same).withColumn("__row", F.struct(*docs.columns))
    rule = F.struct("__fp", F.sha2(utf8(F.col("text")), 256), F.sha2(F.to_json("__row"), 256))
    chosen = met.groupBy("__sim_id", F.col("root").alias("__root")).agg(F.min_by("__row", rule).alias("__row"))
    return kept.unionByName(chosen.select(*[F.col("__row")[c].alias(c) for c in docs.columns]))


def _with_fingerprint(docs: DataFrame, shingle: int) -> DataFrame:
    """``docs`` and the fingerprint ``__fp`` of each row."""
    names = docs.columns

    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in batch.column(batch.num_columns - 1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], names=[*names, "__fp"])

    schema = T.StructType([*docs.schema.fields, T.StructField("__fp", T.LongType())])
    return docs.select(*names, utf8(F.col("text")).alias("__words_of")).mapInArrow(run, schema)
