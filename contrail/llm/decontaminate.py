"""Benchmark decontamination with suffix arrays over the training documents.

Each task cuts its documents into shards of about a million words and builds
the suffix array of a shard over the words that occur in the benchmark (all
other words and document ends share one symbol that matches nothing).  Up to
63 bits of consecutive word numbers form one key; suffixes are sorted by it and
ties by prefix doubling.  Every benchmark suffix is binary-searched: its window
of ``window`` words gives a range of the suffix array, which is every place
where the passage occurs.  Windows that go on along the same diagonal make the
longest verbatim matches.

The benchmark is written once to the shared folder and read by the tasks in
blocks of bounded size, so neither side has to fit in memory.

Cases: null or empty texts have no words and are never contaminated; an item
with fewer words than a window is one window of its own, an item without words
never occurs; items with a null id count, but have no id to list; repeated
documents or items are treated row by row; an empty benchmark marks nothing;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import ship_code, utf8
from contrail.llm.files import locate
from contrail.session import scratch_path

WINDOW, SHARD_WORDS, BLOCK_BYTES = 10, 1_000_000, 16 << 20

# Words: digits, ASCII letters (lower-cased) and every byte of a non-ASCII character.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class _Keys:
    """Consecutive word numbers packed into 64-bit keys; a key ends at its first 0."""

    def __init__(self, vocabulary: int):
        self.bits = max(1, int(vocabulary).bit_length())
        self.per = min(16, 63 // self.bits)

    def pack(self, ids: np.ndarray) -> np.ndarray:
        key, live = np.zeros(len(ids), np.int64), np.ones(len(ids), bool)
        for j in range(self.per):
            nxt = np.zeros(len(ids), np.int64)
            nxt[: max(0, len(ids) - j)] = ids[j:]
            live &= nxt > 0
            key = (key << self.bits) | np.where(live, nxt, 0)
        return key

    def prefix(self, n: int) -> int:
        """Mask of the first n words of a key."""
        return ((1 << self.bits * n) - 1) << self.bits * (self.per - n)


def suffix_array(ids: np.ndarray, key: np.ndarray, per: int) -> np.ndarray:
    """Positions with a known word (id > 0), sorted by the words up to the next 0; ties keep their order."""
    sa = np.flatnonzero(ids)
    if not len(sa):
        return sa
    sa = sa[np.argsort(key[sa], kind="stable")]
    rank = np.zeros(len(ids) + 1, np.int64)
    first = np.flatnonzero(np.r_[True, np.diff(key[sa]) != 0])
    size = np.diff(np.r_[first, len(sa)])
    rank[sa] = np.repeat(first, size) + 1
    zeros = np.flatnonzero(np.r_[ids, 0] == 0)
    longest = int(np.diff(np.r_[-1, zeros]).max())
    depth, at = per, np.flatnonzero(np.repeat(size > 1, size))  # slots of sa that are still tied
    while depth < longest and len(at):
        pos = sa[at]
        nxt = np.where(pos + depth < len(ids), rank[np.minimum(pos + depth, len(ids))], 0)
        order = np.lexsort((nxt, rank[pos]))
        pos, nxt = pos[order], nxt[order]
        group = rank[pos]
        sa[at] = pos
        new = np.r_[True, (np.diff(group) != 0) | (np.diff(nxt) != 0)]
        starts = np.flatnonzero(new)
        size = np.diff(np.r_[starts, len(pos)])
        rank[pos] = np.repeat(at[starts] + 1, size)
        at = at[np.repeat(size > 1, size) & (nxt > 0)]
        depth *= 2
    return sa


def _bound(key: np.ndarray, sa: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, want: np.ndarray, mask: np.ndarray, right: bool) -> np.ndarray:
    """Vectorised bisection of [lo, hi) on the masked key ``depth`` words into each suffix."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        at = sa[np.minimum(mid, len(sa) - 1)] + depth
        got = np.where(at < len(key), key[np.minimum(at, len(key) - 1)], 0) & mask
        up = open_ & ((got <= want) if right else (got < want))
        lo = np.where(up, mid + 1, lo)
        hi = np.where(open_ & ~up, mid, hi)


class Block:
    """The windows of some benchmark items: every suffix that has a whole window."""

    def __init__(self, items: list[list[bytes]], window: int):
        self.number: dict[bytes, int] = {}
        for w in (w for it in items for w in it):
            self.number.setdefault(w, len(self.number) + 1)
        self.keys = _Keys(len(self.number) + 1)
        flat, at, width, item, place = [], [], [], [], []
        for i, it in enumerate(items):
            n = min(window, len(it))
            for p in range(len(it) - n + 1 if n else 0):
                at.append(len(flat) + p)
                width.append(n)
                item.append(i)
                place.append(p)
            flat += [self.number[w] for w in it] + [0]
        key = self.keys.pack(np.array(flat or [0], np.int64))
        self.at, self.width, self.item, self.place = (np.array(x, np.int64) for x in (at, width, item, place))
        per, masks = self.keys.per, np.array([self.keys.prefix(n) for n in range(self.keys.per + 1)], np.int64)
        self.chunks = []  # (depth, wanted key, mask) until the window is covered
        for depth in range(0, int(self.width.max(initial=0)), per):
            mask = masks[np.clip(self.width - depth, 0, per)]
            self.chunks.append((depth, key[np.minimum(self.at + depth, len(key) - 1)] & mask, mask))

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every occurrence in a shard."""
        key = self.keys.pack(ids)
        sa = suffix_array(ids, key, self.keys.per)
        if not len(sa) or not len(self.at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lo, hi = np.zeros(len(self.at), np.int64), np.full(len(self.at), len(sa), np.int64)
        for depth, want, mask in self.chunks:
            lo2 = _bound(key, sa, lo, hi, depth, want, mask, False)
            hi = _bound(key, sa, lo2, hi, depth, want, mask, True)
            lo = lo2
        n = hi - lo
        which = np.repeat(np.arange(len(n)), n)
        slot = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return which, sa[slot]


def _blocks(folder: str, window: int):
    """(row numbers' ids, Block) for bounded pieces of the stored benchmark."""
    fs, path = locate(folder)
    import pyarrow.fs as pafs

    held, size = [], 0
    for f in sorted(fs.get_file_info(pafs.FileSelector(path)), key=lambda f: f.path):
        if not f.path.endswith(".parquet"):
            continue
        for batch in pq.ParquetFile(fs.open_input_file(f.path)).iter_batches(batch_size=1024):
            for item_id, t in zip(batch.column("item_id").to_pylist(), batch.column("t").to_pylist()):
                held.append((item_id, words_of(t)))
                size += len(t)
                if size >= BLOCK_BYTES:
                    yield [i for i, _ in held], Block([w for _, w in held], window)
                    held, size = [], 0
    if held:
        yield [i for i, _ in held], Block([w for _, w in held], window)


_SPAN = ("item_id", "item_position", "position", "words")
_SPAN_TYPE = pa.struct([(n, pa.int64()) for n in _SPAN])


def _matcher(folder: str, window: int):
    def shard(rows, blocks):
        docs = [words_of(t) for _, t in rows]
        lengths = np.array([len(d) for d in docs], np.int64)
        start = np.cumsum(lengths + 1) - lengths - 1  # one separator after each document
        flat = [w for d in docs for w in (*d, b"")]
        total = len(flat)
        cover, best, found = np.zeros(total + 1, np.int64), np.zeros(len(docs), np.int64), [[] for _ in docs]
        spans = [[] for _ in docs]
        for ids, block in blocks:
            number = block.number
            nums = np.fromiter(map(number.get, flat, (0,) * total), np.int64, total)
            which, pos = block.occurrences(nums)
            if not len(pos):
                continue
            width = block.width[which]
            cover += np.bincount(pos, minlength=total + 1) - np.bincount(pos + width, minlength=total + 1)
            doc = np.searchsorted(start, pos, "right") - 1
            for d, i in np.unique(np.stack([doc, block.item[which]], 1), axis=0):
                found[d].append(ids[i])
            # Longest verbatim match: windows that follow each other in item and document.
            order = np.lexsort((pos, block.at[which] - pos))
            p, diag, w, d = pos[order], (block.at[which] - pos)[order], width[order], doc[order]
            new = np.flatnonzero(np.r_[True, (np.diff(diag) != 0) | (np.diff(p) != 1)])
            last = np.r_[new[1:], len(p)] - 1
            words = p[last] + w[last] - p[new]
            np.maximum.at(best, d[new], words)
            first = which[order][new]
            for x, i, a, b, m in zip(d[new].tolist(), block.item[first].tolist(), block.place[first].tolist(), (p[new] - start[d[new]]).tolist(), words.tolist()):
                spans[x].append((ids[i], a, b, m))
        hit = np.r_[0, np.cumsum(np.cumsum(cover[:-1]) > 0)]
        n_hit = hit[start + lengths] - hit[start]
        return pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in rows], pa.int64()), pa.array(lengths), pa.array(n_hit), pa.array(found, pa.list_(pa.int64())), pa.array(best), pa.array([[dict(zip(_SPAN, x)) for x in sp] for sp in spans], pa.list_(_SPAN_TYPE))],
            names=["doc_id", "n_words", "n_hit", "items", "longest", "spans"])

    def run(batches, blocks=None):
        blocks = blocks or _Reread(folder, window)
        rows, size = [], 0
        for batch in batches:
            for row in zip(batch.column("doc_id").to_pylist(), batch.column("t").to_pylist()):
                rows.append(row)
                size += len(row[1])
                if size >= 6 * SHARD_WORDS:  # about six bytes a word
                    yield shard(rows, blocks)
                    rows, size = [], 0
        if rows:
            yield shard(rows, blocks)
    return run


class _Reread:
    """Iterates over the blocks; a single block is kept instead of being read again."""

    def __init__(self, folder: str, window: int):
        self.folder, self.window, self.only = folder, window, None

    def __iter__(self):
        if self.only is not None:
            yield self.only
            return
        n, last = 0, None
        for last in _blocks(self.folder, self.window):
            n += 1
            yield last
        if n == 1:
            self.only = last


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (ids of items with an occurring window), longest,
    spans (the longest verbatim matches: item_id, first word in the item and in the document, number of words)."""
    ship_code(docs.sparkSession)
    folder = scratch_path(docs.sparkSession, "benchmark")
    benchmark.select(F.col("item_id").cast("long").alias("item_id"), utf8(F.col("text")).alias("t")).write.parquet(folder)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("t"))
    return rows.mapInArrow(_matcher(folder, window), "doc_id long, n_words long, n_hit long, items array<long>, longest long, "
                           "spans array<struct<item_id:long,item_position:long,position:long,words:long>>")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, all columns kept."""
    ship_code(docs.sparkSession)
    folder = scratch_path(docs.sparkSession, "benchmark")
    benchmark.select(F.col("item_id").cast("long").alias("item_id"), utf8(F.col("text")).alias("t")).write.parquet(folder)
    match, names = _matcher(folder, window), docs.columns

    def keep(batches):
        blocks = _Reread(folder, window)
        for batch in batches:  # the matcher sees row numbers; whole rows pass through
            t = batch.column(batch.num_columns - 1)
            numbered = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), t], names=["doc_id", "t"])
            clean = [i for out in match([numbered], blocks) for i, n in zip(out.column("doc_id").to_pylist(), out.column("n_hit").to_pylist()) if not n]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=names).take(pa.array(clean, pa.int64()))

    return docs.select(*names, utf8(F.col("text")).alias("__words_of")).mapInArrow(keep, docs.schema)


def digest_of(items: Column) -> Column:
    return F.sha2(F.concat_ws(",", F.array_sort(F.transform(items, lambda i: i.cast("string")))).cast("binary"), 256)
