"""Suffix arrays and decontamination against brute force."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import decontaminate as dc


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(3, 40))
def test_suffix_array_is_sorted(ids, vocabulary):
    ids = np.array(ids, np.int64)
    keys = dc._Keys(vocabulary)
    sa = dc.suffix_array(ids, keys.pack(ids), keys.per).tolist() if len(ids) else []
    def suffix(p):
        out = []
        while p < len(ids) and ids[p]:
            out.append(int(ids[p]))
            p += 1
        return out
    assert sorted(sa) == np.flatnonzero(ids).tolist()
    assert [suffix(p) for p in sa] == sorted(suffix(p) for p in sa)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=80), st.lists(st.lists(st.integers(1, 4), max_size=9), max_size=5), st.integers(1, 6))
def test_occurrences_match_brute_force(doc, items, window):
    words = [[b"%d" % w for w in it] for it in items]
    block = dc.Block(words, window)
    nums = np.array([block.number.get(b"%d" % w, 0) for w in doc], np.int64)
    which, pos = block.occurrences(nums)
    got = sorted((int(block.item[w]), int(block.width[w]), int(p)) for w, p in zip(which, pos))
    want = []
    for i, it in enumerate(items):
        n = min(window, len(it))
        for a in range(len(it) - n + 1 if n else 0):
            want += [(i, n, p) for p in range(len(doc) - n + 1) if doc[p:p + n] == it[a:a + n]]
    assert got == sorted(want)


def brute(docs, items, window=10):
    out = {}
    wins = [(i, w[a:a + min(window, len(w))]) for i, t in items for w in [dc.words_of((t or "").encode())] if w for a in range(max(1, len(w) - window + 1))]
    for d, t in docs:
        w, hit, found = dc.words_of((t or "").encode()), set(), set()
        for i, win in wins:
            for p in range(len(w) - len(win) + 1):
                if w[p:p + len(win)] == win:
                    hit |= set(range(p, p + len(win)))
                    found.add(i)
        out[d] = (len(w), len(hit), sorted(found))
    return out


def test_edge_cases(spark, make):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "Short ITEM"), (3, None), (4, " ,;"), (12, "short item")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1, None), (2, ""), (3, "x alpha, BETA gamma delta. epsilon zeta eta theta iota kappa lambda mu"), (4, "a short? item; short item"),
            (5, "word " * 20000 + "short item"), (6, "alpha beta gamma delta epsilon zeta eta theta iota")]
    got = {r.doc_id: (r.n_words, r.n_hit, sorted(r["items"])) for r in dc.find_contamination(make(docs), bench).collect()}
    assert got == brute(docs, items)
    assert got[3] == (13, 11, [1]) and got[4][1] == 4
    longest = {r.doc_id: r.longest for r in dc.find_contamination(make(docs), bench).collect()}
    assert longest[3] == 11 and longest[4] == 2 and longest[6] == 0
    clean = dc.clean_documents(make(docs), bench)
    assert clean.columns == make(docs).columns
    assert sorted(r.doc_id for r in clean.collect()) == [1, 2, 6]
    assert dc.find_contamination(make(docs).limit(0), bench).collect() == []
    assert {r.n_hit for r in dc.find_contamination(make(docs), bench.limit(0)).collect()} == {0}


def test_several_blocks(spark, docs, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    some = docs.limit(300).cache()
    once = sorted(map(tuple, dc.find_contamination(some, bench).select("doc_id", "n_hit", "longest").collect()))
    monkeypatch.setattr(dc, "BLOCK_BYTES", 500)
    blocks = list(dc._blocks(_store(spark, bench), 10))
    assert len(blocks) > 3
    assert any(h for _, h, _ in once)


def _store(spark, bench):
    from contrail.llm.common import utf8
    from contrail.session import scratch_path
    path = scratch_path(spark, "bench-test")
    bench.select("item_id", utf8(bench.text).alias("t")).write.parquet(path)
    return path


def test_spans_are_the_longest_matches_and_their_places(spark, make):
    item = [f"w{i}" for i in range(30)]
    bench = spark.createDataFrame([(1, "other words"), (2, " ".join(item))], "item_id long, text string")
    docs = [(1, " ".join(["x"] * 3 + item[4:20] + ["y"] + item[15:27])), (2, "a other words other words"), (3, None)]
    got = {r.doc_id: sorted(map(tuple, r.spans)) for r in dc.find_contamination(make(docs), bench).collect()}
    assert got == {1: [(2, 4, 3, 16), (2, 15, 20, 12)], 2: [(1, 0, 1, 2), (1, 0, 3, 2)], 3: []}
