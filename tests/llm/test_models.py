"""Learnt models: held-out quality and defined edge cases."""

from contrail.llm import toxicity as tox
from contrail.llm.common import py_remainder


def test_toxicity_holds_out(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = {r.doc_id: r for r in tox.toxicity_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (py_remainder(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    held = [i for i in truth if i in got and got[i].held_out]
    right = sum(got[i].predicted == truth[i] for i in held) / len(held)
    base = max(sum(truth[i] for i in held), sum(1 - truth[i] for i in held)) / len(held)
    assert right > base and right > 0.93, (right, base)


def test_toxicity_edge_cases(spark, make):
    df = make([(1, None), (2, ""), (3, "you idiot " * 30000), (None, "x"), (4, "fine words"), (4, "fine words")])
    labels = spark.createDataFrame([(3, 1, "z"), (3, 0, "z"), (4, 0, "z"), (None, 1, "z"), (2, None, "z")], "doc_id long, toxic int, shard string")
    rows = tox.toxicity_scores(df, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    none = tox.toxicity_scores(df, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert tox.toxicity_scores(df.limit(0), labels).collect() == []
    assert tox.acceptable(df, labels.limit(0)).columns == df.columns


def test_kneser_ney_sums_to_one():
    from collections import Counter

    import numpy as np

    from contrail.llm import lang_id as li

    counts = Counter(g for w in ["abab", "abba", "baab", "abc", "ca", "a"] * 3 + ["bcb"] for g in li.grams_of(w))
    models = li.Models({"x": dict(counts)})
    assert len(models.probs[0][0]) == 4  # a, b, c and the end mark

    def p(word):
        return np.exp(models.word_scores([word])[0, 0])

    # All words of up to two letters over the alphabet, plus the mass of longer ones, can't exceed one.
    letters = "abc"
    short = sum(p(w) for w in [""] + list(letters) + [a + b for a in letters for b in letters])
    assert 0 < short < 1
    probs, backs, unseen = li.kneser_ney(dict(counts), 5)

    def char(ctx, ch):
        ctx = ctx[-(li.ORDER - 1):]
        if ctx + ch in probs[len(ctx)]:
            return probs[len(ctx)][ctx + ch]
        return char(ctx[1:], ch) + backs[len(ctx)].get(ctx, 0.0) if ctx else unseen

    for ctx in (li.START, li.START + "a", "ab", "bab", "zz", "aab"):
        total = sum(np.exp(char(ctx, ch)) for ch in ["a", "b", "c", li.END, "?"])
        assert abs(total - 1) < 1e-9, (ctx, total)
    w = "abcq"
    full = li.START + w + li.END
    want = sum(char(full[max(0, i - 3):i], full[i]) for i in range(1, len(full)))
    assert abs(models.word_scores([w])[0, 0] - want) < 1e-4


def test_language_holds_out(spark, docs):
    from contrail.llm import lang_id as li

    truth = {r.doc_id: (r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect()}
    got = {r.doc_id: r for r in li.languages(docs).collect()}
    assert len(got) == len(truth)
    held = [i for i in got if py_remainder(i, 3) == 1]
    assert all(got[i].held_out == (py_remainder(i, 3) == 1) and 0 <= got[i].score <= 1 for i in got)
    right = sum(got[i].lang_pred == truth[i][0] for i in held) / len(held)
    assert right > 0.97, right


def test_language_edge_cases(spark, make):
    from contrail.llm import lang_id as li

    df = make([(1, None), (2, ""), (3, "123 ²½ ..."), (4, "abc " * 30000), (None, "x" * 300), (5, "abc"), (5, "abc"), (7, "xyz q")])
    df = df.selectExpr("doc_id", "text", "case when text like 'x%' then 'zz' when doc_id = 2 then null else lang end lang", "source", "n", "h")
    rows = sorted(((r.doc_id or 0), r.lang_pred, r.score > 0) for r in li.languages(df).collect())
    assert [r[1] for r in rows if r[0] in (1, 2, 3)] == ["und"] * 3 and len(rows) == 8
    assert all(r[1] in ("en", "zz") for r in rows if r[0] in (4, 5, 7))
    assert {r.lang_pred for r in li.languages(df.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}
    assert li.languages(df.limit(0)).collect() == []


def _seatings(c, others, p, d, theta):
    """Exact distribution of the number of tables by walking through all seatings of c customers."""
    import math

    weights = {}

    def seat(tables, w):
        if sum(tables) == c:
            weights[len(tables)] = weights.get(len(tables), 0) + w
            return
        for k in range(len(tables)):
            seat(tables[:k] + (tables[k] + 1,) + tables[k + 1:], w * (tables[k] - d))
        seat(tables + (1,), w * (theta + d * (others + len(tables))) * p)

    seat((1,), (theta + d * others) * p)
    total = math.fsum(weights.values())
    return [weights.get(t, 0) / total for t in range(1, c + 1)]


def test_table_draws_follow_the_seating_distribution():
    import numpy as np

    from contrail.llm import pitman_yor as py

    rng = np.random.default_rng(0)
    for c, others, p, d, theta in ((2, 0, 0.3, 0.5, 1.0), (5, 3, 0.05, 0.7, 1.0), (6, 40, 0.2, 0.4, 10.0)):
        n = 40_000
        t = py.draw_tables(np.full(n, c), np.full(n, others), np.full(n, p), d, theta, py.stirling(d), rng)
        got = np.bincount(t, minlength=c + 1)[1:] / n
        assert np.abs(got - _seatings(c, others, p, d, theta)).max() < 0.012
    # Large parties: the block rule agrees with the exact rule at its limit.
    for d, theta, p, others in ((0.6, 1.0, 0.02, 50), (0.8, 1.0, 0.05, 400), (0.9, 1.0, 0.001, 9000), (0.4, 10.0, 0.2, 5)):
        exact = py.draw_tables(np.full(4000, py.EXACT), np.full(4000, others), np.full(4000, p), d, theta, py.stirling(d), rng)
        larger = py.draw_tables(np.full(4000, py.EXACT + 1), np.full(4000, others), np.full(4000, p), d, theta, py.stirling(d), rng)
        assert abs(exact.mean() - larger.mean()) < 0.1 * exact.mean() + 0.1, (d, p, exact.mean(), larger.mean())
        assert abs(exact.std() - larger.std()) < 0.2 * exact.std() + 0.1, (d, p, exact.std(), larger.std())


def _score(spark, df):
    from contrail.llm import pitman_yor as py

    return {r.doc_id: r for r in py.score_texts(df).collect()}


def test_scores_match_counts_and_beat_unigrams(spark, docs, rows):
    import math
    from collections import Counter

    got = _score(spark, docs)
    train = Counter()
    words = {i: [w for w in (t or "").encode().lower().split()] + [None] for i, t in rows}
    for i, ws in words.items():
        if py_remainder(i, 7) != 2:
            train.update(ws)
    n, v = sum(train.values()), len(train)
    for i, ws in words.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (py_remainder(i, 7) == 2, len(ws), sum(w in train for w in ws), n)
        assert abs(r.base_score - sum(math.log10((train[w] + 1) / (n + v + 1)) for w in ws)) < 1e-6 * len(ws)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.97  # higher log probability
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_model_is_a_distribution():
    """Over all known words and the unknown one the probabilities of every context add up to one."""
    import numpy as np

    from contrail.llm import pitman_yor as py

    rng = np.random.default_rng(3)
    words, contexts = 30, 4
    keys = np.unique(rng.integers(0, words, 400) * 8 + rng.integers(0, contexts + 1, 400) * 1)
    keys = keys[(keys % 8) <= contexts]
    counts = rng.integers(1, 90, len(keys))
    word = keys // 8
    used, word = np.unique(word, return_inverse=True)
    row = {"bucket": 0, "hashes": np.arange(10, 10 + len(used), dtype=np.uint64).tobytes(), "words": word.astype(np.uint32).tobytes(),
           "contexts": (keys % 8).astype(np.uint32).tobytes(), "counts": counts.astype(np.int64).tobytes()}
    customers = np.bincount(keys % 8, weights=counts, minlength=contexts + 1)
    shape = py.Shape(contexts, customers, 0.6, 0.5, len(used))
    history = []
    b = py.Bucket(row)
    cells = dict(zip(*(c.to_pylist() for c in b.rows().columns)))
    history.append(py._totals(cells, contexts))
    for _ in range(py.BURN_IN + py.KEPT):
        b = py.Bucket(row)
        for _ in b.replay(shape, history):
            pass
        history.append(py._totals(dict(zip(*(c.to_pylist() for c in b.rows().columns))), contexts))
    asked_words = np.append(np.arange(10, 10 + len(used)), 999).astype(np.uint64)
    for ctx in range(contexts + 1):
        (_, logs), = py.probabilities(py.Bucket(row), shape, history, [(asked_words, np.ones(len(asked_words), np.uint32), np.full(len(asked_words), ctx, np.uint32))])
        assert abs((10 ** logs).sum() - 1) < 1e-9


def test_scoring_edge_cases(spark, make):
    df = make([(1, None), (2, ""), (3, "a " * 50000), (None, "a b"), (4, "a b c"), (4, "a b c"), (11, "zz yy")])
    from contrail.llm import pitman_yor as py

    rows = sorted(((r.doc_id or 0), r.n_tokens, r.score <= 0) for r in py.score_texts(df).collect())
    assert rows == [(0, 3, True), (1, 1, True), (2, 1, True), (3, 50001, True), (4, 4, True), (4, 4, True), (11, 3, True)]
    assert py.score_texts(df.limit(0)).collect() == []
    none = df.filter("crc32(cast(cast(coalesce(cast(doc_id as string), '') as string) as binary)) % 7 = 2")
    assert all(r.train_tokens == 0 and r.score == 0 and r.base_score == 0 for r in py.score_texts(none).collect())


def test_every_seen_context_has_a_restaurant(spark, make, monkeypatch):
    """Rare contexts predict their words, and scores do not depend on how rows lie in units and partitions."""
    import numpy as np

    from contrail.llm import pitman_yor as py

    monkeypatch.setattr(py, "SHARE", 1e-2, raising=False)
    monkeypatch.setattr(py, "UNIT", 300)
    rng = np.random.default_rng(4)
    texts = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 60) % 400) + (" rare pair" if i % 90 == 1 else "")) for i in range(300)]
    trained = sum(t.endswith("rare pair") and py_remainder(i, 7) != 2 for i, t in texts)
    assert trained >= 2
    asked = [i for i in range(1000, 1200) if py_remainder(i, 7) == 2][:2]
    texts += [(asked[0], "rare pair"), (asked[1], "w1 pair")]
    df = make(texts)
    one, other = (_score(spark, x) for x in (df.coalesce(1), df.repartition(5, "text")))
    assert all(abs(one[i].score - other[i].score) < 1e-4 for i in one)
    gain = one[asked[0]].score - one[asked[0]].base_score, one[asked[1]].score - one[asked[1]].base_score
    assert gain[0] > gain[1] + 1
