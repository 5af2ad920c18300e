"""Stored Kneser-Ney models against the plain estimate in memory."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import lang_id as li


def _corpus():
    r = random.Random(4)
    words = {lang: ["".join(r.choice(letters) for _ in range(r.randint(1, 9))) for _ in range(60)] for lang, letters in (("a", "abcde"), ("b", "cdéfg"), ("c", "ğh😀ij"))}
    return [(i, " ".join(r.choice(words[lang]) for _ in range(40)) + " 12, x!", lang) for i, lang in enumerate(r.choice("abc") for _ in range(90))]


def _counts(rows):
    out = {}
    for _, text, lang in rows:
        into = out.setdefault(lang, Counter())
        for w in li.words_of(text):
            into.update(li.grams_of(w))
    return {lang: dict(c) for lang, c in out.items()}


@pytest.mark.parametrize("block, partitions", [(1 << 15, 1), (7, 4), (50, 16)])
def test_stored_models_equal_the_plain_estimate(spark, monkeypatch, block, partitions):
    """All n-grams, whatever the blocks and partitions."""
    monkeypatch.setattr(li, "BLOCK", block)
    rows = _corpus()
    counts = _counts(rows)
    flat = [(0, lang, g, n) for lang, c in counts.items() for g, n in c.items()] + [(1, "a", g, n) for g, n in counts["a"].items()]
    got = li.fit(spark.createDataFrame(flat, "model int, lang string, gram string, n long").repartition(partitions))
    plain = li.Models(counts)
    words = sorted({w for _, t, _ in rows for w in li.words_of(t)}) + ["zzz", "abcédğ", "q", "a" * 300]
    assert got[0].langs == plain.langs
    assert np.abs(got[0].word_scores(words) - plain.word_scores(words)).max() < 1e-3
    own = li.Models({"a": counts["a"]}).word_scores(words)[:, 0]
    assert np.abs(got[1].word_scores(words)[:, 0] - own).max() < 1e-3
    assert (got[1].word_scores(words)[:, 1] < own - 100).all()  # a language that the second set has not seen


def test_a_small_cache_reads_blocks_again(spark, monkeypatch):
    monkeypatch.setattr(li, "BLOCK", 16)
    monkeypatch.setattr(li, "CACHE_BYTES", 600)
    rows = _corpus()
    counts = _counts(rows)
    got = li.fit(spark.createDataFrame([(0, lang, g, n) for lang, c in counts.items() for g, n in c.items()], "model int, lang string, gram string, n long"))[0]
    words = sorted({w for _, t, _ in rows for w in li.words_of(t)})
    assert np.abs(got.word_scores(words) - li.Models(counts).word_scores(words)).max() < 1e-3
    assert li.Blocks._held <= 600 + 16 * (8 + 4 * 3)


def test_scores_do_not_depend_on_partitions(spark):
    rows = spark.createDataFrame(_corpus(), "doc_id long, text string, lang string")
    answers = [sorted((r.doc_id, r.lang_pred, round(r.score, 9), r.rejected) for r in li.languages(rows.repartition(n)).collect()) for n in (1, 4, 16)]
    assert answers[0] == answers[1] == answers[2]


def test_edge_cases(spark, make):
    long = "abcdef" * 20000  # one word
    df = make([(1, None), (2, ""), (3, "12 ..."), (4, "some words"), (4, "some words"), (None, "more words"), (6, long), (7, "words " * 50000)])
    got = {r.doc_id: r for r in li.languages(df).collect()}
    assert li.languages(df).count() == 8
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3))
    assert all(got[i].lang_pred == "en" for i in (4, None, 6, 7))
    assert li.languages(df.limit(0)).collect() == []
    assert {r.lang_pred for r in li.languages(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
