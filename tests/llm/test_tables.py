"""Exact dedup, the mixture and the registered SQL twins."""

import hashlib
from collections import defaultdict
from fractions import Fraction

import pytest

from contrail.llm import exact_dedup, mixture
from contrail.llm.queries import ORACLE, QUERIES
from tools.oracle_check import TABLES, digest


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_duckdb(spark, duck, key):
    df = QUERIES[key](spark, "/root/testdata/sf0.001")
    cur = duck.execute(ORACLE[key])
    cols = [d[0] for d in cur.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, cur.fetchall())[0]


def test_exact_groups_edge_cases(spark, make):
    long = "long " * 40000
    df = make([(1, None), (2, ""), (3, " "), (4, long), (5, long), (6, long + "x"), (7, "é"), (8, "é"), (9, "dup"), (9, "dup"), (None, "dup"), (None, "alone")])
    got = sorted(((r.doc_id or 0), r.keep_id or 0, r.group_size, r.kept) for r in exact_dedup.exact_groups(df).collect())
    assert [g for g in got if g[0] in range(1, 9)] == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 5, 2, False), (5, 5, 2, True), (6, 6, 1, True),
                                                       (7, 8, 2, False), (8, 8, 2, True)]
    assert sorted(g for g in got if g[0] == 9) == [(9, 9, 3, False), (9, 9, 3, True)]  # exactly one row of the group stays
    assert sorted(g for g in got if g[0] == 0) == [(0, 0, 1, True), (0, 9, 3, False)]
    shas = {r.doc_id: r.text_sha256 for r in exact_dedup.exact_groups(df).collect()}
    assert shas[4] == hashlib.sha256(long.encode()).hexdigest() and shas[1] == hashlib.sha256(b"").hexdigest()
    assert exact_dedup.exact_groups(df.limit(0)).collect() == []


def test_a_group_over_many_partitions(spark, make):
    """A text that most rows share is cut between partitions and joined again."""
    df = make([(i, "same" if i % 10 else f"other {i}") for i in range(3000)], extra=False).repartition(7)
    rows = exact_dedup.exact_groups(df).collect()
    same = [r for r in rows if r.doc_id % 10]
    assert {(r.keep_id, r.group_size) for r in same} == {(2999, 2700)}
    assert [r.doc_id for r in rows if r.kept and r.doc_id % 10] == [2999]
    assert sum(r.kept for r in rows) == 301


def _targets(sizes, weights=(5, 2, 1), share=Fraction(3, 2), limit=2):
    """Water-filling by brute force: raise the rate, cap what passes its limit, repeat."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    budget, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rate = (budget - sum(limit * sizes[s] for s in capped)) / sum(w[s] for s in free) if free else 0
        over = {s for s in free if rate * w[s] > limit * sizes[s]}
        if not over:
            return {s: float(limit * sizes[s] if s in capped else rate * w[s]) for s in order}
        capped |= over


def test_mixture_edge_cases(spark, make):
    names = ["b", None, "a", "é", "Z", "a", "hot"]
    texts, sources = [], []
    for i in range(400):
        texts.append((i, None if i % 97 == 0 else "" if i % 89 == 0 else "w " * (i % 37 + 1)))
        sources.append(names[i % 7] if i < 200 else "hot")
    texts += [(500, "x " * 60000), (501, "y"), (501, "y"), (None, "no id")]
    sources += ["b", "Z", "Z", "a"]
    data = [(i, t, s, 7, "clash") for (i, t), s in zip(texts, sources)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, size long, h string")
    rows = mixture.mix(df).collect()
    assert len(rows) == len(data)
    sizes, words = defaultdict(int), {}
    for (i, t), s in zip(texts, sources):
        n = len((t or "").split())
        sizes[s] += n
        words[i] = n
    want = _targets(sizes)
    src = {i: s for (i, _), s in zip(texts, sources)}
    took = defaultdict(int)
    for r in rows:
        s = src[r.doc_id]
        assert r.size == words[r.doc_id] and r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        took[s] += r.taken
    for s, t in want.items():
        assert abs(took[s] - t) <= max(words[i] for i in words if src[i] == s)
    assert sorted(map(str, rows)) == sorted(map(str, mixture.mix(df.repartition(5)).collect()))  # reruns agree
    assert mixture.mix(df.limit(0)).collect() == []
    out = mixture.mixed_documents(df)
    assert out.columns == df.columns
    copies = defaultdict(int)
    for r in out.collect():
        copies[r.doc_id] += len((r.text or "").split())
    by_id = defaultdict(int)
    for r in rows:
        by_id[r.doc_id] += r.taken
    assert {i: n for i, n in copies.items() if n} == {i: n for i, n in by_id.items() if n}
