"""Token ids as length-delimited binary records with a separate offset index.

Documents are range-partitioned and sorted by id; each task encodes its part
and writes one record file and one index file.

File: the mark ``TOKREC`` and the width of an id (2 or 4 bytes, by the size of the
vocabulary), then records.  Record: u64 length of the payload, u32 masked
checksum of those 8 bytes, the payload (little-endian token ids of that width),
u32 masked checksum of the payload.  A masked checksum is crc32 rotated right by 15 bits plus 0xA282EAD8, so that a
checksum stored inside checksummed data does not look like one.
Index entry (24 bytes): document id i64, byte offset of its record u64, number
of ids u32, flag u32 (1: the id is null).  With it a reader can take records in
any order; ``read_at`` does so.

A pre-token never crosses white space in the vocabularies used here, so equal
words are encoded once per worker and looked up after that, by Arrow among those of the
last pieces of text and by a dict among the others; the ids are those of encoding the whole text.  Words of plain Latin letters need no normalising
beyond lower case and go straight to the vocabulary's model, if the vocabulary
is of that kind (lower case, byte-level, letters a pre-token of their own).

Cases: null or empty text gives only the end id; rows with equal ids keep all
their records, ordered by a hash of the text; null ids come first; no rows give
no files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import ship_code, tidy, utf8, written
from contrail.llm.files import attempt_name, open_in, open_out
from contrail.session import scratch_path

_MARK = b"TOKREC"
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_LATIN_THEN_MARKS = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\\[-`{-~]+)")
# Byte-level vocabularies name printable bytes by themselves and the others by 256, 257, ... in order.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_NAMED = dict(zip([b for b in range(256) if b not in _SHOWN], range(256, 512)))
_LEN, _CRC, _ENTRY = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qQII")
_MANIFEST = "pid int, records string, index string, docs long, tokens long"
_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
PIECE_BYTES = 8 << 20     # text encoded at a time
CACHE_BYTES = 40 << 20     # words and ids that a worker remembers
COLUMN_BYTES = 16 << 20    # words and ids that it remembers as Arrow columns, as they were met
_ENTRY_BYTES = 190         # of a remembered word: two objects and its slot


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(ids: bytes) -> bytes:
    size = _LEN.pack(len(ids))
    return b"".join((size, _CRC.pack(masked(size)), ids, _CRC.pack(masked(ids))))


def file_mark(width: int) -> bytes:
    return _MARK + width.to_bytes(2, "little")


def width_of(f) -> int:
    f.seek(0)
    mark = f.read(8)
    if mark[:6] != _MARK:
        raise OSError("not a token record file")
    return int.from_bytes(mark[6:], "little")


def index_entry(doc_id: int | None, offset: int, n: int) -> bytes:
    return _ENTRY.pack(doc_id or 0, offset, n, doc_id is None)


class WordEncoder:
    """Bytes of little-endian ids for a text, encoding each distinct word once.

    What a worker remembers is bounded by bytes.
    """

    _shared: dict[str, WordEncoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.words: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.held = 0
        self.met = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.latin = self._splits_at_letters()

    def _splits_at_letters(self) -> bool:
        """Lower case and byte-level, with runs of letters and runs of marks as pre-tokens."""
        spec = json.loads(self.tokenizer.to_str())
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        return (kinds == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in pre] == ["Split", "ByteLevel"] and not pre[1]["add_prefix_space"]
                and pre[0]["pattern"].get("Regex", "").endswith("|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"))

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls._shared:  # one per Python worker, kept over its tasks
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def learn(self, missing: list[str]) -> None:
        dtype, rest, tokenize, code = f"<u{self.width}", [], self.tokenizer.model.tokenize, "H" if self.width == 2 else "I"
        words, latin, swap, held = self.words, self.latin, sys.byteorder == "big", 0
        for w in missing:
            ascii_ = w.isascii()
            if latin and (w.isalpha() if ascii_ else _LATIN.fullmatch(w)):
                low = w.lower()
                ids = words.get(low)
                if ids is None:
                    ids = array(code, [t.id for t in tokenize(low if ascii_ else low.encode().decode("latin-1").translate(_NAMED))])
                    if swap:
                        ids.byteswap()
                    ids = ids.tobytes()
                words[w] = ids
                held += _ENTRY_BYTES + len(w) + len(ids)
            else:
                rest.append(w)
        self.held += held
        for i in range(0, len(rest), 2000):
            part = rest[i : i + 2000]
            got = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            raw = np.array(got.ids, dtype).tobytes()
            ends = (self.width * np.searchsorted(np.array(got.word_ids, dtype=np.int64), np.arange(len(part) + 1))).tolist()
            for w, a, b in zip(part, ends, ends[1:]):
                self._keep(w, raw[a:b])

    def _keep(self, word: str, ids: bytes) -> None:
        self.words[word] = ids
        self.held += _ENTRY_BYTES + len(word) + len(ids)

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words; only those that are not known yet are encoded.

        Words are remembered in two generations: when the younger one has reached half of
        ``CACHE_BYTES`` it becomes the older, and what the older held and nobody asked for again is forgotten.
        """
        if self.held > CACHE_BYTES // 2:
            self.older, self.words, self.held = self.words, {"": b""}, 0
        known, older, missing, split = self.words, self.older, [], []
        out = [known.get(w) for w in words]
        latin, fits = self.latin, _LATIN_THEN_MARKS.fullmatch
        for i, ids in enumerate(out):
            if ids is None:
                w = words[i]
                ids = older.get(w)
                if ids is not None:
                    self._keep(w, ids)
                    out[i] = ids
                elif latin and not w.isalpha() and (m := fits(w)):
                    split.append((i, *m.groups()))  # letters and the marks behind them are pre-tokens of their own, and are remembered as such
                else:
                    missing.append(i)
        parts = {p for _, *ps in split for p in ps if p not in known}
        for p in parts.intersection(older):
            self._keep(p, older[p])
            parts.discard(p)
        wanted = [words[i] for i in missing]
        self.learn([*wanted, *parts.difference(wanted)])
        for i, w in zip(missing, wanted):
            out[i] = known[w]
        for i, letters, marks in split:
            out[i] = known[letters] + known[marks]
        return out

    def _column(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words; those of the pieces before are found by Arrow, only the others become Python strings."""
        met, ids = self.met
        at = pc.index_in(words, value_set=met)
        missing = words.filter(at.is_null())
        if len(missing):
            met = pa.concat_arrays([met, missing])
            ids = pa.concat_arrays([ids, pa.array(self._ids(missing.to_pylist()), pa.large_binary())])
            new = at.is_null().to_numpy(zero_copy_only=False)
            at = pa.array(np.where(new, len(met) - len(missing) - 1 + np.cumsum(new), at.fill_null(0).to_numpy()))
        out = ids.take(at)
        self.met = (words, out) if met.nbytes + ids.nbytes > COLUMN_BYTES else (met, ids)  # the last piece's alone when they grow too large
        return out

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text of a column: split and numbered by Arrow, every distinct word looked up once."""
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        numbered = words.flatten().dictionary_encode()
        ids = self._column(numbered.dictionary).take(numbered.indices)
        offsets = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, 8 * ids.offset) if len(ids) else np.zeros(1, np.int64)
        ends = offsets[np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))])].tolist()
        raw = memoryview(ids.buffers()[2]) if len(ids) and ids.buffers()[2] is not None else b""
        return [bytes(raw[a:b]) for a, b in zip(ends, ends[1:])]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        return self.encode_column(pa.array(texts, pa.binary()))


def pieces(batch: pa.RecordBatch, column: str, size: int):
    """Slices of a batch with about ``size`` bytes in ``column``, one row at least."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _writer(folder: str, vocabulary: str, end_id: int):
    def write(batches):
        pid, encoder, end = TaskContext.get().partitionId(), None, None
        rec = idx = None
        docs = tokens = offset = 0
        names = [attempt_name(folder, pid, ".rec"), attempt_name(folder, pid, ".idx")]
        for batch in batches:
            for part in pieces(batch, "t", PIECE_BYTES):
                if rec is None:
                    rec, idx, encoder = open_out(names[0]), open_out(names[1]), WordEncoder.of(vocabulary)
                    end = end_id.to_bytes(encoder.width, "little")
                    offset = rec.write(file_mark(encoder.width))
                out, entries = [], []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode_column(part.column("t"))):
                    ids += end
                    out.append(frame(ids))
                    entries.append(index_entry(doc_id, offset, len(ids) // encoder.width))
                    offset += len(out[-1])
                    tokens += len(ids) // encoder.width
                rec.write(b"".join(out))
                idx.write(b"".join(entries))
                docs += len(entries)
        if rec is not None:
            rec.close()
            idx.close()
            tidy()
            yield pa.RecordBatch.from_pydict({"pid": [pid], "records": [names[0]], "index": [names[1]], "docs": [docs], "tokens": [tokens]},
                                             schema=pa.schema([("pid", pa.int32()), ("records", pa.string()), ("index", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]))
    return write


def write_records(docs: DataFrame, vocabulary: str, end_id: int = 2, folder: str | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the record and index files; returns the committed manifest, one row per file pair."""
    ship_code(docs.sparkSession)
    folder = folder or scratch_path(docs.sparkSession, "records")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("t")).withColumn("h", F.xxhash64("t"))
    ranged = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "t")
    return written(ranged.mapInArrow(_writer(folder, vocabulary, end_id), _MANIFEST), "manifest")


def index_entries(uri: str) -> np.ndarray:
    with open_in(uri) as f:
        return np.frombuffer(f.read(), dtype=np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("n", "<u4"), ("null", "<u4")]))


def read_at(f, offset: int, width: int) -> np.ndarray:
    """The ids of the record at a byte offset, checksums verified."""
    f.seek(offset)
    head = f.read(12)
    if masked(head[:8]) != _CRC.unpack(head[8:])[0]:
        raise OSError("length checksum does not match")
    n = _LEN.unpack(head[:8])[0]
    body = f.read(n + 4)
    if masked(body[:n]) != _CRC.unpack(body[n:])[0]:
        raise OSError("payload checksum does not match")
    return np.frombuffer(body[:n], dtype=f"<u{width}").astype("<u4")


def _read_files(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for row in batch.to_pylist():
            entries = index_entries(row["index"])
            starts = row["base"] + np.concatenate([[0], np.cumsum(entries["n"].astype(np.int64))])
            with open_in(row["records"]) as f:
                width = width_of(f)
                for at in range(0, len(entries), 4096):
                    part, crcs, sizes = entries[at : at + 4096], [], []
                    for e in part:
                        ids = read_at(f, int(e["offset"]), width)
                        crcs.append(zlib.crc32(ids))
                        sizes.append(len(ids))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part["doc_id"].astype(np.int64), mask=part["null"] == 1), pa.array(starts[at : at + len(part)]),
                         pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())], schema=schema)


def read_records(manifest: DataFrame) -> DataFrame:
    """One row per record, in file order: doc_id, start, n_tokens, ids_crc32 (from the files alone)."""
    ship_code(manifest.sparkSession)
    spark = manifest.sparkSession
    # One row per file: the running token count gives each file its base.
    files, base = [], 0
    for r in sorted(manifest.select("pid", "records", "index", "tokens").collect()):
        files.append((r["records"], r["index"], base))
        base += r["tokens"]
    if not files:
        return spark.createDataFrame([], _READ)
    return spark.createDataFrame(files, "records string, index string, base long").repartition(len(files)).mapInArrow(_read_files, _READ)


def records_round_trip(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    return read_records(write_records(docs, vocabulary, end_id))
