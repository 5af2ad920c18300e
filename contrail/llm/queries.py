"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import table
from contrail.llm.decontaminate import digest_of, find_contamination
from contrail.llm.exact_dedup import exact_groups
from contrail.llm.lang_id import languages
from contrail.llm.mixture import mix
from contrail.llm.passages import passage_classes
from contrail.llm.pitman_yor import score_texts
from contrail.llm.private_spans import BASE, places, private_spans
from contrail.llm.simhash import simhash_components
from contrail.llm.token_records import records_round_trip
from contrail.llm.toxicity import toxicity_scores
from contrail.llm.turn_repair import repair_conversations
from contrail.llm.warc import archive_round_trip
from contrail.llm.whitening import whitened

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return keep


OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS n, sha1(b) AS h, max(page_id) OVER (PARTITION BY b) AS first FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> first THEN first END AS refers_to
FROM d
"""


@query("op1_warc", OP1_SQL)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a WARC record per page, normalise the whole-stream archives and read them back."""
    return archive_round_trip(table(spark, sf_dir, "pages"), least=1000).drop("url")


@query("op2_language")
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text by Kneser-Ney character models."""
    return languages(table(spark, sf_dir, "documents"), folds=3, left_out=1)


@query("op3_passages")
def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that repeat, at similarity 0.8 or more, across documents, and the classes they join."""
    return passage_classes(table(spark, sf_dir, "documents"))


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of 3-word shingles and their components within 3 bits."""
    out = simhash_components(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


OP5_SQL = r"""
WITH b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
        FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS u(i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM win),
d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
gram AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g FROM d, ks, unnest(range(1, len(w) - k + 2)) AS u(i)),
occ AS (SELECT doc_id, i, gram.k, item_id FROM gram JOIN win ON gram.k = win.k AND gram.g = win.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM occ, unnest(range(i, i + k)) AS u(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op5_decontaminate", OP5_SQL)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in a 10-word passage of the benchmark."""
    out = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      digest_of(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@query("op6_token_records")
def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's token ids as framed records and read the files back."""
    return records_round_trip(table(spark, sf_dir, "documents"), vocabulary(), end_id=2)


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         CAST('0x' || substr(md5(doc_id::VARCHAR), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s),
-- Caps bind in the order of cap / weight: rate k holds when the first k sources are capped.
o AS (SELECT *, 2.0 * source_size / weight AS bind,
        coalesce(sum(2 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
        sum(weight) OVER (ORDER BY 2.0 * source_size / weight DESC, source DESC ROWS UNBOUNDED PRECEDING) AS free,
        1.5 * sum(source_size) OVER () AS budget FROM w),
r AS (SELECT arg_min((budget - held) / free, bind) FILTER (WHERE (budget - held) / free <= bind) AS rate FROM o),
t AS (SELECT w.source, source_size, least(2.0 * source_size, rate * weight)::DOUBLE AS target FROM w, r),
p AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS passes
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, target - passes * source_size AS rest, sum(size) OVER (PARTITION BY source ORDER BY h) AS upto,
        sum(size) OVER (PARTITION BY source, h) AS own FROM p)
SELECT doc_id, size, source_size, target,
       (size * least(2, passes + CASE WHEN upto <= rest OR (upto - own <= rest AND (rest - (upto - own)) * 2 >= own) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""


@query("op7_mixture", OP7_SQL)
def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to a mix of all sources at 150 % of their size."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query("op8_exact_dedup", OP8_SQL)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact groups of whole texts; the largest id of each stays."""
    return exact_groups(table(spark, sf_dir, "documents"))


@query("op9_pitman_yor")
def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every whole text under a hierarchical Pitman-Yor word model."""
    return score_texts(table(spark, sf_dir, "documents"), folds=7, left_out=2)


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of whole texts from FTRL-proximal logistic regression."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=5)


OP11_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS r0, coalesce(text, ' ') AS t0,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS name
  FROM conversations),
coded AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, name), lambda crc, c:
           list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
         4294967295) % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE r0 END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(t0, '.!?', '') ELSE t0 END AS text
  FROM coded, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS u(copy)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
marked AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE 'f' END AS fault FROM placed),
pairs AS (
  SELECT conv_id, initial, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS prev, pos FROM marked),
stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) AS n FROM marked GROUP BY conv_id),
wrong AS (
  SELECT conv_id, count(*) AS illegal FROM pairs WHERE pos > 1 AND prev || initial NOT IN ('su', 'ua', 'au') GROUP BY conv_id),
-- States: n nothing, s, u, a the last role written.  Inserts and edits lead from one to another.
ins(a, b, cost, letters, lines) AS (
  VALUES ('n', 'n', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
         ('n', 'u', 5, 'I', chr(10) || 'user:'), ('s', 'u', 5, 'I', chr(10) || 'user:'), ('a', 'u', 5, 'I', chr(10) || 'user:'), ('u', 'a', 5, 'I', chr(10) || 'assistant:'),
         ('n', 'a', 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), ('s', 'a', 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
edit(a, letter, initial, b, cost) AS (
  VALUES ('n', 'K', 's', 's', 0), ('n', 'K', 'u', 'u', 0), ('s', 'K', 'u', 'u', 0), ('a', 'K', 'u', 'u', 0), ('u', 'K', 'a', 'a', 0),
         ('n', 'R', NULL, 'u', 1), ('s', 'R', NULL, 'u', 1), ('a', 'R', NULL, 'u', 1), ('u', 'R', NULL, 'a', 1),
         ('n', 'D', NULL, 'n', 2), ('s', 'D', NULL, 's', 2), ('u', 'D', NULL, 'u', 2), ('a', 'D', NULL, 'a', 2)),
walk AS (
  SELECT conv_id, 0::BIGINT AS pos, 'n' AS state, {'cost': 0, 'audit': '', 'lines': ''} AS best FROM stats
  UNION ALL
  SELECT w.conv_id, w.pos + 1, e.b, min({'cost': w.best.cost + i.cost + e.cost + CASE WHEN m.fault = 't' AND e.letter <> 'D' THEN 5 ELSE 0 END,
         'audit': w.best.audit || i.letters || e.letter,
         'lines': w.best.lines || i.lines || CASE e.letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || m.role || ':' || m.text
                  ELSE chr(10) || CASE e.b WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || m.text END})
  FROM walk w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.pos = w.pos + 1 JOIN ins i ON i.a = w.state
  JOIN edit e ON e.a = i.b AND (e.initial IS NULL OR e.initial = m.initial) AND (e.letter = 'D' OR m.fault NOT IN ('b', 'd'))
  GROUP BY w.conv_id, w.pos, e.b),
done AS (
  SELECT w.conv_id, min({'cost': w.best.cost + i.cost, 'audit': w.best.audit || i.letters, 'lines': w.best.lines || i.lines}) AS best
  FROM walk w JOIN stats s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.pos JOIN ins i ON i.a = w.state
  WHERE i.b IN ('n', 'a') GROUP BY w.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN wrong w ON w.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op11_turn_repair", OP11_SQL)
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every damaged conversation."""
    out = repair_conversations(table(spark, sf_dir, "conversations"))
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@query("op12_private_spans")
def op12_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole text: counts and digest of the base spans, and all spans."""
    out = private_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *map(count, BASE), F.sha2(places(base), 256).alias("base_sha256"), places(F.col("spans")).alias("spans"))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened coordinates of every usable embedding."""
    return whitened(table(spark, sf_dir, "embeddings"))
