"""Token records: exact round trip."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from contrail.llm import token_records as tr
from contrail.llm.files import open_in
from contrail.llm.queries import vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary())


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_round_trip_matches_whole_text_encoding(spark, docs, rows, tokenizer):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tr.records_round_trip(docs, vocabulary()).collect()}
    start, want = 0, {}
    for i, t in sorted(rows):
        ids = np.array(whole(tokenizer, t), "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list(" \t\n\r\x0b\x0c\x1c\x85\xa0'.,!?:;#$astdAZ19Éßüÿ×é́ΣßİDž<|>")), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=4))
def test_word_encoder_equals_whole_text(texts):
    enc = tr.WordEncoder.of(vocabulary())
    texts = [*texts, "<|endoftext|> don't, it's. we'll?! <|startoftext|>x"]
    got = enc.encode([t.encode() for t in texts])
    assert [np.frombuffer(g, f"<u{enc.width}").tolist() for g in got] == [whole(enc.tokenizer, t)[:-1] for t in texts]


def test_edge_cases_and_random_access(spark, make, tokenizer):
    df = make([(5, None), (3, ""), (None, "null id"), (7, "b a"), (7, "c a"), (1, "word " * 50000)])
    manifest = tr.write_records(df, vocabulary())
    got = [(r.doc_id, r.start, r.n_tokens) for r in tr.read_records(manifest).orderBy("start").collect()]
    assert [g[0] for g in got] == [None, 1, 3, 5, 7, 7]
    assert [g[2] for g in got] == [3, 50001, 1, 1, 3, 3]
    assert [g[1] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1]]
    row = manifest.orderBy("pid").collect()[-1]
    entry = tr.index_entries(row["index"])[-1]
    with open_in(row["records"]) as f:
        assert len(tr.read_at(f, int(entry["offset"]), tr.width_of(f))) == entry["n"]
    assert tr.records_round_trip(df.limit(0), vocabulary()).collect() == []


def test_damaged_record_is_noticed(tmp_path):
    import io

    body = np.array([1, 2, 3], "<u4").tobytes()
    size = tr._LEN.pack(len(body))
    good = size + tr._CRC.pack(tr.masked(size)) + body + tr._CRC.pack(tr.masked(body))
    assert tr.read_at(io.BytesIO(good), 0, 4).tolist() == [1, 2, 3]
    bad = bytearray(good)
    bad[14] ^= 1
    with pytest.raises(OSError):
        tr.read_at(io.BytesIO(bytes(bad)), 0, 4)


def test_words_with_marks_are_remembered_by_their_parts(tokenizer):
    """A word and the marks behind it are two pre-tokens; what a worker remembers holds each once."""
    encoder = tr.WordEncoder(vocabulary())
    texts = ["Stone, stone. stone! STONE,", "stone; moss, Moss."]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, f"<u{encoder.width}").tobytes() for t in texts]
    assert [bytes(x) for x in encoder.encode([t.encode() for t in texts])] == want
    assert set(encoder.words) == {"", "Stone", "stone", "STONE", "moss", "Moss", ",", ".", "!", ";"}


def test_words_of_the_pieces_before_are_found_as_columns(tokenizer, monkeypatch):
    """Only words that no piece before had become Python strings; forgetting them changes no ids."""
    for size in (tr.COLUMN_BYTES, 0):
        monkeypatch.setattr(tr, "COLUMN_BYTES", size)
        encoder, asked = tr.WordEncoder(vocabulary()), []
        inner = encoder._ids
        monkeypatch.setattr(encoder, "_ids", lambda words, inner=inner, asked=asked: asked.append(words) or inner(words))
        texts = ["Stone don't moss,", "moss, fern Stone", "", "Stone fern fern rain"]
        want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, f"<u{encoder.width}").tobytes() for t in texts]
        assert [bytes(encoder.encode([t.encode()])[0]) for t in texts] == want
        assert asked == [["Stone", "don't", "moss,"], ["fern"], [""], ["rain"] if size else ["Stone", "fern", "rain"]]
