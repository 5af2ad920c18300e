"""The pipeline's stages against what each must do to its own input."""

import corpus_pipeline as cp
from contrail.llm import decontaminate as dc
from contrail.llm import mixture, simhash, toxicity
from contrail.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixture", "token_records"]
    stages = dict(cp.STAGES)

    scores = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(docs, table(spark, SF, "labels")).collect()}
    one = written(stages["toxicity"](spark, docs, SF), "t1")
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.collect()) == sorted(i for i, p in scores.items() if not p)

    comp = {r.doc_id: r.component_id for r in simhash.simhash_components(one).collect()}
    two = written(stages["near_duplicates"](spark, one, SF), "t2")
    assert two.columns == docs.columns
    assert sorted(r.doc_id for r in two.collect()) == sorted(set(comp.values()))

    hit = {r.doc_id: r.n_hit for r in dc.find_contamination(two, table(spark, SF, "benchmark")).collect()}
    three = written(stages["decontamination"](spark, two, SF), "t3")
    assert three.columns == docs.columns and any(hit.values())
    assert sorted(r.doc_id for r in three.collect()) == sorted(i for i, n in hit.items() if not n)

    plan = {r.doc_id: r.copies for r in mixture.mix(three).collect()}
    four = written(stages["mixture"](spark, three, SF), "t4")
    assert four.columns == docs.columns
    assert sorted(r.doc_id for r in four.collect()) == sorted(i for i, n in plan.items() for _ in range(n))

    five = stages["token_records"](spark, four, SF).orderBy("start").collect()
    assert [r.doc_id for r in five] == sorted(i for i, n in plan.items() for _ in range(n))
    assert all(b.start == a.start + a.n_tokens for a, b in zip(five, five[1:]))
    whole = cp.run(spark, SF).orderBy("start").collect()
    assert whole == five


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0


def test_rows_that_share_an_id(spark, make):
    """Every text keeps a document, whatever other rows stand at its id."""
    a, b, c = ("alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight", "red green blue white black pink grey gold")
    got = simhash.one_of_each(make([(2, b), (5, b), (5, a), (7, c), (7, c), (None, a), (None, a)]))
    assert sorted(((r.doc_id or 0), r.text) for r in got.collect()) == [(0, a), (0, a), (2, b), (5, a), (7, c)]
    two = simhash.one_of_each(make([(5, a), (5, b), (6, a), (6, b)]))  # two components with one smallest id
    assert sorted((r.doc_id, r.text) for r in two.collect()) == [(5, a), (5, b)]


def test_stages_take_every_kind_of_row(spark, make):
    """Null and empty texts, repeated rows, ties, a very long text and clashing columns pass all stages; clean rows stay."""
    long = " ".join(f"word{i % 5000}" for i in range(60000))
    texts = [(1, None), (2, ""), (3, "a plain text about nothing in particular at all"), (4, long), (5, long), (6, "another text of a few plain words"),
             (6, "another text of a few plain words"), (None, "a text without an id but with words")]
    docs = make(texts)
    expected = {"toxicity": len(texts), "near_duplicates": 5, "decontamination": 5}
    for name, stage in cp.STAGES[:-1]:
        out = written(stage(spark, docs, SF), name)
        assert out.columns == docs.columns
        if name in expected:
            assert out.count() == expected[name], name
        docs = out
    last = cp.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == docs.count() and sorted(r.n_tokens for r in last)[-1] > 60000
