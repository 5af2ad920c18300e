"""SimHash near-dedup against brute force."""

import numpy as np
import xxhash

from contrail.llm import simhash


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    """{id: smallest id reachable} over all pairs."""
    ids, values = np.array([i for i, _ in fps]), np.array([f for _, f in fps], np.uint64)
    label = ids.copy()
    while True:
        new = label.copy()
        for k in range(len(ids)):
            near = np.bitwise_count(values ^ values[k]) <= 3
            new[k] = label[near].min()
        if (new == label).all():
            return dict(zip(ids.tolist(), label.tolist()))
        label = new


def test_components_match_brute_force(spark, docs, rows):
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in simhash.simhash_components(docs).collect()}
    fps = [(i, brute_fp(t)) for i, t in rows]
    want = brute_components(fps)
    assert got == {i: (f, want[i]) for i, f in fps}


def test_dense_group_of_near_copies(spark, monkeypatch):
    """Thousands of distinct fingerprints in one ball, through the split of large keys and its blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 128)
    rng = np.random.default_rng(1)
    centre = np.uint64(0x0123456789ABCDEF)
    values = {int(centre)}
    while len(values) < 900:
        v = centre
        for b in rng.choice(64, rng.integers(1, 5), replace=False):
            v ^= np.uint64(1) << np.uint64(b)
        values.add(int(v))
    values |= {int(x) for x in rng.integers(0, 2**63, 300)}
    fps = list(enumerate(sorted(values)))
    nodes = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for _, v in fps], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(nodes)).collect()}
    want = brute_components(fps)
    groups = {}
    for i, v in fps:
        s = int(np.uint64(v).view(np.int64))
        groups.setdefault(want[i], set()).add(roots.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_edge_cases(spark, make):
    df = make([(5, None), (3, ""), (9, "  \t "), (None, ""), (7, "one two"), (8, "one two"), (8, "one two"), (1, "a b c " * 30000)])
    got = sorted((r.doc_id or -1, r.fp == 0, r.component_id) for r in simhash.simhash_components(df).collect())
    assert got == [(-1, True, 3), (1, False, 1), (3, True, 3), (5, True, 3), (7, False, 7), (8, False, 7), (8, False, 7), (9, True, 3)]
    assert simhash.simhash_components(df.limit(0)).collect() == []
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 3, 7]
