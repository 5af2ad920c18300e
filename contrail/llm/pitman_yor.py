"""Scoring with a hierarchical Pitman-Yor word model.

Restaurants: one for each context word that a training text has (and for the start
of a text), all sharing the root as their parent.  The root's base is uniform over the known words and one unknown word.
With c customers and t tables for a word, and c., t. in all,

    p(w | u) = (c - d t + (theta + d t.) p_root(w)) / (theta + c.)

and likewise for the root.  Seating is sampled by Gibbs sweeps: the number of
tables of each word in each restaurant is drawn from its conditional, in which
the arrangements of c customers at t tables count with a generalised Stirling
number (exact up to ``EXACT`` customers, by its scaling law beyond).  All restaurants of a sweep are sampled in parallel against the totals
of the sweep before.  Probabilities are averaged over the sweeps kept.

How it runs: texts are cut into units of about ``UNIT`` tokens, written as files
of word numbers.  Each unit sends every distinct (word, context) once, with its
training count, to the bucket of the word's hash, so a word that a third of all
tokens share costs one entry a unit.  A bucket holds its words' counts in all
contexts and numbers the contexts it meets.  A context's tables lie in many buckets;
after each sweep the buckets send their sums to the bucket of the context's hash,
its home, and get the totals of the contexts they meet back as a file.  A sweep
reseeds by (bucket, sweep) and keeps its seating in a file of the bucket.  The driver
gets two sums and the file names of each bucket.
The buckets then answer each unit with the probabilities of its pairs, which the unit adds up.

Cases: null and empty texts are one end token; a null id belongs to the class of
the empty id; repeated rows are learnt from and scored as often as they occur;
without training texts every token has the base probability 1; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import py_remainder, ship_code, tidy, utf8, written
from contrail.llm.files import attempt_name, open_in, open_out
from contrail.session import scratch_path

UNIT = 2_500_000
BURN_IN, KEPT = 2, 3
EXACT = 256
BUCKET_ENTRIES = 2_000_000  # tokens for each bucket
LEAST_BUCKETS = 16
THETA, THETA_ROOT = 1.0, 10.0
START_HASH = xxhash.xxh64_intdigest(b" ")  # no word contains a space
END_WORD = b""  # no word is empty


# ---- units -------------------------------------------------------------------

def _squeeze(a: np.ndarray) -> bytes:
    return pa.compress(a.tobytes(), codec="zstd", asbytes=True)


def _packed(a: np.ndarray) -> bytes:
    """Compressed byte by byte: the high bytes of most numbers are alike."""
    return np.int64(a.nbytes).tobytes() + _squeeze(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T) if len(a) else b""


def _unpacked(data: bytes, dtype) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype)
    raw = pa.decompress(data[8:], decompressed_size=int(np.frombuffer(data, np.int64, 1)[0]), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _save(folder: str, number: int, arrays: list[np.ndarray]) -> str:
    path = attempt_name(folder, number, ".arrays")
    with open_out(path) as f:
        for a in arrays:
            raw = _packed(a)
            f.write(np.array([len(raw), ord(a.dtype.char)], np.int64).tobytes() + raw)
    return path


def _read(path: str) -> list[np.ndarray]:
    out = []
    with open_in(path) as f:
        while head := f.read(16):
            size, kind = np.frombuffer(head, np.int64).tolist()
            out.append(_unpacked(f.read(size), chr(kind)))
    return out


class Unit:
    """Texts as numbers of the unit's distinct words, which are sorted by hash."""

    def __init__(self, ids, train, lengths, hashes, tokens):
        self.ids, self.train, self.lengths, self.hashes, self.tokens = ids, train, lengths, hashes, tokens

    @classmethod
    def of(cls, rows: list[tuple[int | None, bytes]], folds: int, left_out: int) -> Unit:
        number = defaultdict(count().__next__)
        tokens, lengths = [], []
        for _, t in rows:
            words = t.lower().split()
            words.append(END_WORD)
            tokens.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
            lengths.append(len(words))
        h = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
        order = np.argsort(h)
        place = np.empty(len(h), np.uint32)
        place[order] = np.arange(len(h), dtype=np.uint32)
        train = np.array([py_remainder(i, folds) != left_out for i, _ in rows], bool)
        return cls([i for i, _ in rows], train, np.array(lengths, np.int64), h[order], place[np.concatenate(tokens)])

    def save(self, f) -> None:
        parts = [json.dumps(self.ids).encode(), self.train.tobytes(), self.lengths.tobytes(), self.hashes.tobytes(), _squeeze(self.tokens)]
        f.write(np.array([len(p) for p in parts] + [self.tokens.nbytes], np.int64).tobytes())
        for p in parts:
            f.write(p)

    @classmethod
    def load(cls, f) -> Unit:
        sizes = np.frombuffer(f.read(48), np.int64).tolist()
        ids, train, lengths, hashes, tokens = (f.read(n) for n in sizes[:5])
        raw = pa.decompress(tokens, decompressed_size=sizes[5], codec="zstd", asbytes=True) if sizes[5] else b""
        return cls(json.loads(ids), np.frombuffer(train, bool), np.frombuffer(lengths, np.int64), np.frombuffer(hashes, np.uint64), np.frombuffer(raw, np.uint32))

    def learns(self) -> np.ndarray:
        """Per token: does it belong to a training text?"""
        return np.repeat(self.train, self.lengths)

    def contexts(self) -> np.ndarray:
        """Hashes of the contexts by number: the unit's words, then the start of a text."""
        return np.append(self.hashes, np.uint64(START_HASH))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted distinct word * width + context, which of them each token is)."""
        width = len(self.hashes) + 1
        before = np.empty(len(self.tokens), np.int64)
        before[1:] = self.tokens[:-1]
        before[np.cumsum(self.lengths) - self.lengths] = width - 1
        return np.unique(self.tokens.astype(np.int64) * width + before, return_inverse=True)


_UNITS = "unit long, path string, train_tokens long, entries long"


def _unit_writer(folder: str, folds: int, left_out: int):
    def emit(rows, pid, k):
        unit = Unit.of(rows, folds, left_out)
        path = attempt_name(folder, pid, ".unit")
        with open_out(path) as f:
            unit.save(f)
        return pa.RecordBatch.from_arrays([pa.array([(pid << 24) | k]), pa.array([path]), pa.array([int(unit.learns().sum())]), pa.array([len(unit.tokens)])],
                                          names=["unit", "path", "train_tokens", "entries"])

    def run(batches):
        pid, rows, size, k = TaskContext.get().partitionId(), [], 0, 0
        for batch in batches:
            for row in zip(batch.column("doc_id").to_pylist(), batch.column("t").to_pylist()):
                rows.append(row)
                size += len(row[1]) // 6 + 1  # about six bytes a token
                if size >= UNIT:
                    yield emit(rows, pid, k)
                    rows, size, k = [], 0, k + 1
        if rows:
            yield emit(rows, pid, k)
        tidy()
    return run


# ---- buckets -----------------------------------------------------------------

def _cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes: buckets are equal ranges of the hash."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


_REQUEST = "bucket int, unit long, path string, hashes binary, sizes binary, names binary, contexts binary, counts binary"
_REQUESTED = {"hashes": np.uint64, "sizes": np.uint32, "names": np.uint64, "contexts": np.uint32, "counts": np.uint32}


def _steps(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=np.uint64(0))


def _requests(buckets: int):
    """The distinct pairs of each unit with their training counts, dealt by word hash."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with open_in(row["path"]) as f:
                    unit = Unit.load(f)
                named = unit.contexts()
                keys, which = unit.pairs()
                word, ctx = keys // len(named), keys % len(named)
                seen = np.bincount(which, weights=unit.learns(), minlength=len(keys)).astype(np.uint32)
                sizes = np.bincount(word, minlength=len(unit.hashes)).astype(np.uint32)
                cut = _cuts(unit.hashes, buckets)
                ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[cut]
                for b in range(buckets):
                    w, p = slice(cut[b], cut[b + 1]), slice(ends[b], ends[b + 1])
                    met, number = np.unique(ctx[p], return_inverse=True)
                    parts = {"hashes": _steps(unit.hashes[w]), "sizes": sizes[w], "names": _steps(named[met]), "contexts": number.astype(np.uint32), "counts": seen[p]}
                    yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([row["unit"]]), pa.array([row["path"]]),
                                                      *(pa.array([_packed(x)], pa.binary()) for x in parts.values())], names=["bucket", "unit", "path", *parts])
        tidy()
    return run


_MODEL = "bucket int, held string, units array<long>, paths array<string>, asked string"


def _merger(folder: str):
    def run(group: pa.Table) -> pa.Table:
        try:
            return _merge(group, folder)
        finally:
            tidy()
    return run


def _merge(group: pa.Table, folder: str) -> pa.Table:
    """The training pairs of one bucket: word numbers (by sorted hash), contexts (1 + place among the sorted hashes of all
    that the bucket is asked for) and counts, in a file; what each unit asks, in another."""
    number, requests = group.column("bucket")[0].as_py(), group.select(["unit", "path"]).to_pylist()
    rows = [{k: _unpacked(group.column(k)[i].as_py(), t) for k, t in _REQUESTED.items()} for i in range(group.num_rows)]
    for r in rows:
        r.update({k: np.cumsum(r[k], dtype=np.uint64) for k in ("hashes", "names")})
    hashes = np.unique(np.concatenate([r["hashes"] for r in rows]))
    names = np.unique(np.concatenate([r["names"] for r in rows]))
    keys, counts, asked = [], [], [hashes]
    for r in rows:
        place, ctx = np.searchsorted(hashes, r["hashes"]), (np.searchsorted(names, r["names"]) + 1)[r["contexts"]]
        some = r["counts"] > 0
        keys.append((np.repeat(place, r["sizes"])[some] << 32) | ctx[some])
        counts.append(r["counts"][some])
        asked += [place.astype(np.uint32), r["sizes"], ctx.astype(np.uint32)]
    path = _save(folder, number, asked)
    rows.clear()
    asked.clear()
    key, count = np.concatenate(keys), np.concatenate(counts)
    keys.clear()
    order = np.argsort(key)
    key, count = key[order], count[order]
    first = np.flatnonzero(np.r_[True, np.diff(key) != 0][: len(key)])
    total = np.add.reduceat(count, first, dtype=np.int64) if len(key) else count.astype(np.int64)
    key = key[first]
    used = np.unique(key >> 32)  # words of training texts only
    word = np.searchsorted(used, key >> 32).astype(np.uint32)
    held = _save(folder, number, [hashes[used], names, word, (key & 0xFFFFFFFF).astype(np.uint32), total])
    return pa.table({"bucket": pa.array([number], pa.int32()), "held": pa.array([held]), "units": pa.array([[r["unit"] for r in requests]], pa.list_(pa.int64())),
                     "paths": pa.array([[r["path"] for r in requests]], pa.list_(pa.string())), "asked": pa.array([path])})


# ---- seating -----------------------------------------------------------------

def stirling(discount: float) -> np.ndarray:
    """[c, t]: log number (weighted by the discount) of seatings of c customers at t tables."""
    s = np.full((EXACT + 1, EXACT + 1), -np.inf)
    s[0, 0] = 0.0
    t = np.arange(EXACT + 1)
    with np.errstate(divide="ignore"):
        for c in range(EXACT):
            s[c + 1] = s[c] + np.log(np.maximum(c - discount * t, 0))
            s[c + 1, 1:] = np.logaddexp(s[c + 1, 1:], s[c, :-1])
    return s


def draw_tables(c: np.ndarray, others: np.ndarray, p: np.ndarray, discount: float, theta: float, table: np.ndarray, rng) -> np.ndarray:
    """Tables of each party of c customers that eat one dish of parent probability p, ``others`` tables being taken in the room."""
    t = np.minimum(c, 1).astype(np.int64)
    order = np.argsort(c, kind="stable")
    edges = np.searchsorted(c[order], np.arange(2, EXACT + 2))
    for n, a, b in zip(range(2, EXACT + 1), edges, edges[1:]):
        for at in range(a, b, max(1, 250_000 // n)):
            some = order[at : min(b, at + max(1, 250_000 // n))]
            open_ = np.log(theta + discount * (others[some, None] + np.arange(n))) + np.log(p[some, None])
            w = np.cumsum(open_, 1) + table[n, 1 : n + 1]
            w = np.cumsum(np.exp(w - w.max(1, keepdims=True)), 1)
            t[some] = 1 + (w < rng.random(len(some))[:, None] * w[:, -1:]).sum(1)
    big = order[edges[-1] :]
    for at in range(0, len(big), 2048):
        some = big[at : at + 2048]
        t[some] = draw_large(c[some], others[some], p[some], discount, theta, table, rng)
    return t


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x > 0 (recurrence up to 8, then the asymptotic series)."""
    x = np.asarray(x, float)
    shift, y = np.zeros_like(x), x.copy()
    for _ in range(8):
        low = y < 8
        shift = np.where(low, shift + np.log(np.where(low, y, 1)), shift)
        y = np.where(low, y + 1, y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def large_seatings(c: np.ndarray, t: np.ndarray, discount: float, table: np.ndarray) -> np.ndarray:
    """log Stirling numbers for c > EXACT.

    S(c, t) = c! / (t! d^t) P(X1 + ... + Xt = c) with Sibuya(d) variables X; the
    ratio of that probability to t P(X1 = c) tends to a function of t / c^d
    alone, which is read off the exact row of EXACT customers.
    """
    def lead(c, t):
        one = math.log(discount) + lgamma(c - discount) - math.lgamma(1 - discount)  # with c! cancelled
        return one + np.log(t) - lgamma(t + 1) - t * math.log(discount)

    known = np.arange(1, EXACT + 1)
    ratio = table[EXACT, 1:] - lead(np.full(EXACT, float(EXACT)), known)
    u, grid = t / c**discount, known / EXACT**discount
    beyond = ratio[-1] * (np.maximum(u, grid[-1]) / grid[-1]) ** (1 / (1 - discount))  # the tail of a stable law
    return lead(c, t) + np.where(u > grid[-1], beyond, np.interp(u, np.append(0, grid), np.append(0, ratio)))


def draw_large(c, others, p, discount, theta, table, rng) -> np.ndarray:
    """Tables of parties of more than EXACT customers: a draw from a grid of 65 points around the mode."""
    c, room = c.astype(float), theta / discount + others

    def weight(t):
        shape = (slice(None),) + (None,) * (t.ndim - 1)
        cc, r = np.broadcast_to(c[shape], t.shape), room[shape]
        return lgamma(r + t) - lgamma(r + 0 * t) + t * np.log(discount * p[shape]) + large_seatings(cc, t, discount, table)

    lo, hi = np.ones(len(c)), c.copy()
    while (hi - lo).max() > 1:  # the weights rise up to their mode
        mid = np.floor((lo + hi) / 2)
        rising = (weight(mid + 1) > weight(mid)) & (hi - lo > 1)
        lo, hi = np.where(rising, mid, lo), np.where(rising | (hi - lo <= 1), hi, mid)
    mode = np.where(weight(hi) > weight(lo), hi, lo)
    bend = 2 * weight(mode) - weight(np.minimum(mode + 1, c)) - weight(np.maximum(mode - 1, 1))
    wide = 8 / np.sqrt(np.clip(bend / 2, 1e-12, 1)) + 8
    lo, hi = np.maximum(1, mode - wide), np.minimum(c, mode + wide)
    step = np.maximum(1, (hi - lo) / 64)
    grid = np.floor(lo)[:, None] + step[:, None] * np.arange(65)
    w = np.where(grid <= hi[:, None] + 1e-9, weight(np.minimum(grid, c[:, None])), -np.inf)
    w = np.cumsum(np.exp(w - w.max(1, keepdims=True)), 1)
    pick = np.minimum((w < rng.random(len(c))[:, None] * w[:, -1:]).sum(1), 64)
    at = grid[np.arange(len(c)), pick] + np.where(step > 1, (rng.random(len(c)) - 0.5) * step, 0)
    return np.clip(np.rint(at), 1, c).astype(np.int64)


class Totals:
    """What all buckets of a sweep add up to: tables by context, customers and tables of the root."""

    def __init__(self, tables: np.ndarray, customers: float, root_tables: float):
        self.tables, self.customers, self.root_tables = tables, customers, root_tables


class Shape:
    """Numbers fixed for all sweeps."""

    def __init__(self, contexts: int, customers=None, discount=0.5, root_discount=0.5, vocabulary=0):
        self.contexts, self.customers = contexts, customers  # customers by context
        self.discount, self.root_discount, self.vocabulary = discount, root_discount, vocabulary

    @property
    def base(self) -> float:
        return 1.0 / (self.vocabulary + 1)


class Bucket:
    """The words of one bucket, their training pairs and a seating."""

    def __init__(self, row: dict):
        self.number = row["bucket"]
        self.hashes = np.frombuffer(row["hashes"], np.uint64)
        self.word = np.frombuffer(row["words"], np.uint32).astype(np.int64)
        self.ctx = np.frombuffer(row["contexts"], np.uint32).astype(np.int64)
        self.c = np.frombuffer(row["counts"], np.int64)
        self.names = np.frombuffer(row.get("names", b""), np.uint64)
        self.inner = self.ctx > 0
        self.seated: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # seatings after a sweep that are known already
        self.t = np.ones(len(self.c), np.int64)  # of a context's restaurant; root pairs have no tables of their own
        self.root_t = np.ones(len(self.hashes), np.int64)

    @classmethod
    def load(cls, row: dict) -> Bucket:
        return cls({"bucket": row["bucket"], **dict(zip(("hashes", "names", "words", "contexts", "counts"), _read(row["held"])))})

    def customers(self) -> np.ndarray:
        """Of the root, by word: the tables of its children and the tokens that sit there directly."""
        return np.bincount(self.word, weights=np.where(self.inner, self.t, self.c), minlength=len(self.hashes))

    def root_p(self, shape: Shape, totals: Totals, customers=None, tables=None) -> np.ndarray:
        r = self.customers() if customers is None else customers
        t = self.root_t if tables is None else tables
        return (r - shape.root_discount * t + (THETA_ROOT + shape.root_discount * totals.root_tables) * shape.base) / (THETA_ROOT + totals.customers)

    def sweep(self, shape: Shape, before: Totals, number: int, tables: tuple[np.ndarray, np.ndarray]) -> None:
        rng = np.random.default_rng([self.number, number])
        r = self.customers()
        many = np.flatnonzero(self.inner & (self.c > 1))
        w, own = self.word[many], self.t[many]
        rest = r[w] - own  # the word's customers in the root besides this party's
        p = self.root_p(shape, before, rest, np.where(rest > 0, np.minimum(self.root_t[w], rest), 0))
        others = np.maximum(before.tables[self.ctx[many]] - own, 0)
        self.t[many] = draw_tables(self.c[many], others, p, shape.discount, THETA, tables[0], rng)
        r = self.customers().astype(np.int64)
        others = np.maximum(before.root_tables - self.root_t, 0)
        self.root_t = draw_tables(r, others, np.full(len(r), shape.base), shape.root_discount, THETA_ROOT, tables[1], rng)

    def replay(self, shape: Shape, history: list[Totals]):
        """The seatings after sweeps 1 .. len(history); history[k] holds the totals before sweep k + 1."""
        tables = None
        for k, before in enumerate(history):
            if k + 1 in self.seated:
                self.t, self.root_t = self.seated[k + 1]
            else:
                tables = tables or (stirling(shape.discount), stirling(shape.root_discount))
                self.sweep(shape, before, k + 1, tables)
            yield self

    def rows(self) -> pa.RecordBatch:
        """(cell, n): tables by context, then -1 root customers, -2 root tables."""
        by = np.bincount(self.ctx[self.inner], weights=self.t[self.inner]).astype(np.int64)
        at = np.flatnonzero(by)
        cells = np.concatenate([at, [-1, -2]])
        n = np.concatenate([by[at], [int(self.customers().sum()), int(self.root_t.sum())]])
        return pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(n, pa.int64())], names=["cell", "n"])


def _totals(cells: dict[int, int], contexts: int) -> Totals:
    tables = np.zeros(contexts + 1)
    for k, n in cells.items():
        if k >= 0:
            tables[k] = n
    return Totals(tables, cells.get(-1, 0), cells.get(-2, 0))


_SENT = "bucket int, home int, data binary, path string, name string, n long"


def _sent(bucket: Bucket, buckets: int, columns: list[np.ndarray], path: str | None, sums: dict[str, int]):
    """Columns (by the bucket's contexts) cut by home; then a row for each sum, with the path of the seating."""
    cut = _cuts(bucket.names, buckets)
    for home in range(buckets):
        part = slice(cut[home], cut[home + 1])
        if part.start < part.stop:
            yield (bucket.number, home, _packed(np.concatenate([x[part] for x in columns]).astype(np.int64)), None, None, None)
    for name, n in sums.items():
        yield (bucket.number, None, None, path, name, int(n))


_SENT_FIELDS = [("bucket", pa.int32()), ("home", pa.int32()), ("data", pa.binary()), ("path", pa.string()), ("name", pa.string()), ("n", pa.int64())]


def _batches(rows):
    rows = list(rows)
    for at in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows[at : at + 64]), _SENT_FIELDS)], names=[n for n, _ in _SENT_FIELDS])


def _own(bucket: Bucket) -> Totals:
    """What a bucket adds to the totals."""
    cells, n = bucket.rows().columns
    return _totals(dict(zip(cells.to_pylist(), n.to_pylist())), len(bucket.names))


def _survey(buckets: int):
    """Before any sweep: customers and tables by context, and the counts of counts that give the discounts."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = Bucket.load(row)
                c, r, own = b.c, b.customers(), _own(b)
                customers = np.bincount(b.ctx, weights=b.c, minlength=len(b.names) + 1)[1:]
                sums = {"c1": (c == 1).sum(), "c2": (c == 2).sum(), "r1": (r == 1).sum(), "r2": (r == 2).sum(), "words": len(b.hashes),
                        "customers": own.customers, "root_tables": own.root_tables}
                yield from _batches(_sent(b, buckets, [customers, own.tables[1:]], None, sums))
                del b, c, r, own, customers
                tidy()
    return run


def _homes(folder: str, buckets: int):
    """Where the contexts of each bucket stand among those of a home, as a file of the home."""
    def deal(batches):
        for batch in batches:
            for bucket, held in zip(batch.column("bucket").to_pylist(), batch.column("held").to_pylist()):
                names = _read(held)[1]
                cut = _cuts(names, buckets)
                some = [h for h in range(buckets) if cut[h] < cut[h + 1]]
                if some:
                    yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(some), pa.int32()), pa.array(some, pa.int32()),
                                                      pa.array([names[cut[h] : cut[h + 1]].tobytes() for h in some], pa.binary())], names=["bucket", "home", "data"])

    def keep(group: pa.Table) -> pa.Table:
        home, rows = group.column("home")[0].as_py(), sorted(zip(group.column("bucket").to_pylist(), group.column("data").to_pylist()))
        names = [np.frombuffer(x, np.uint64) for _, x in rows]
        _, at = np.unique(np.concatenate(names), return_inverse=True)
        path = _save(folder, home, [np.array([b for b, _ in rows]), np.array([len(x) for x in names]), at])
        tidy()
        return pa.table({"number": pa.array([home], pa.int32()), "path": pa.array([path])})
    return deal, keep


_FILE = "number int, path string"


def _add_at_home(homes: dict[int, str]):
    """Totals of a home's contexts, for each bucket those that it meets."""
    def run(group: pa.Table) -> pa.Table:
        home = group.column("home")[0].as_py()
        buckets, sizes, at = _read(homes[home])
        data = dict(zip(group.column("bucket").to_pylist(), group.column("data").to_pylist()))
        parts = [_unpacked(data[b], np.int64).reshape(-1, n) for b, n in zip(buckets.tolist(), sizes.tolist())]
        sent = np.concatenate(parts, axis=1)
        total = np.stack([np.bincount(at, weights=x).astype(np.int64)[at] for x in sent])
        ends = np.cumsum(sizes)[:-1]
        return pa.table({"bucket": pa.array(buckets, pa.int32()), "home": pa.array([home] * len(buckets), pa.int32()),
                         "data": pa.array([_packed(x.ravel()) for x in np.split(total, ends, axis=1)], pa.binary())})
    return run


def _bring_back(folder: str, columns: int):
    """The totals of a bucket's contexts, in a file."""
    def run(group: pa.Table) -> pa.Table:
        bucket, rows = group.column("bucket")[0].as_py(), sorted(zip(group.column("home").to_pylist(), group.column("data").to_pylist()))
        path = _save(folder, bucket, list(np.concatenate([_unpacked(x, np.int64).reshape(columns, -1) for _, x in rows], axis=1)))
        return pa.table({"number": pa.array([bucket], pa.int32()), "path": pa.array([path])})
    return run


class Rooms:
    """Files of each bucket: customers of its contexts, tables before each sweep, seatings after it; and the sums over all buckets."""

    def __init__(self):
        self.customers: dict[int, str] = {}
        self.tables: list[dict[int, str]] = []
        self.seatings: list[dict[int, str]] = []
        self.sums: list[tuple[int, int]] = []

    def totals(self, number: int, k: int) -> Totals:
        tables = _read(self.tables[0][number])[-1] if number in self.tables[0] else np.zeros(0)
        if k and len(tables):
            tables = tables + _read(self.tables[k][number])[0]  # tables beyond the first of each pair
        return Totals(np.append(0.0, tables), *self.sums[k])

    def shape(self, number: int, shape: Shape) -> Shape:
        customers = _read(self.customers[number])[0] if number in self.customers else np.zeros(0)
        return Shape(len(customers), np.append(0.0, customers), shape.discount, shape.root_discount, shape.vocabulary)

    def seat(self, bucket: Bucket, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The seating after sweep k + 1."""
        t, root_t = _read(self.seatings[k][bucket.number])
        return t.copy(), root_t.copy()


def _sweeper(shape: Shape, rooms: Rooms, buckets: int, folder: str):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                bucket, k = Bucket.load(row), len(rooms.seatings)
                if k:
                    bucket.t, bucket.root_t = rooms.seat(bucket, k - 1)
                bucket.sweep(shape, rooms.totals(bucket.number, k), k + 1, (stirling(shape.discount), stirling(shape.root_discount)))
                own = _own(bucket)
                path = _save(folder, bucket.number, [bucket.t, bucket.root_t])
                more = own.tables[1:] - np.bincount(bucket.ctx, minlength=len(bucket.names) + 1)[1:]  # than one for each pair
                yield from _batches(_sent(bucket, buckets, [more], path, {"customers": own.customers, "root_tables": own.root_tables}))
                del bucket, own, more
                tidy()
    return run


def _discount(n1: int, n2: int) -> float:
    return min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5


def fit(model: DataFrame, buckets: int) -> tuple[Shape, Rooms]:
    """Gibbs sweeps over the bucket table."""
    spark = model.sparkSession
    deal, keep = _homes(scratch_path(spark, "homes"), buckets)
    files = lambda df: {r["number"]: r["path"] for r in df.collect()}
    homes = files(written(model.select("bucket", "held").mapInArrow(deal, "bucket int, home int, data binary").groupBy("home").applyInArrow(keep, _FILE), "homes-list"))
    rooms = Rooms()

    def exchange(sent: DataFrame, columns: int) -> dict[int, str]:
        back = sent.filter("home is not null").select("bucket", "home", "data").groupBy("home").applyInArrow(_add_at_home(homes), "bucket int, home int, data binary")
        return files(written(back.groupBy("bucket").applyInArrow(_bring_back(scratch_path(spark, "rooms"), columns), _FILE), "rooms-list"))

    def sums(sent: DataFrame) -> dict[str, int]:
        return {r["name"]: r["n"] for r in sent.filter("home is null").groupBy("name").agg(F.sum("n").alias("n")).collect()}

    sent = written(model.mapInArrow(_survey(buckets), _SENT), "survey")
    n = sums(sent)
    shape = Shape(0, None, _discount(n["c1"], n["c2"]), _discount(n["r1"], n["r2"]), n["words"])
    rooms.customers = exchange(sent, 2)
    rooms.tables.append(rooms.customers)
    rooms.sums.append((n["customers"], n["root_tables"]))
    for _ in range(BURN_IN + KEPT):
        sent = written(model.mapInArrow(_sweeper(shape, rooms, buckets, scratch_path(spark, "seatings")), _SENT), "sweep")
        n = sums(sent)
        rooms.seatings.append({r["bucket"]: r["path"] for r in sent.filter("name = 'customers'").select("bucket", "path").collect()})
        rooms.tables.append(exchange(sent, 1))
        rooms.sums.append((n["customers"], n["root_tables"]))
    return shape, rooms


def probabilities(bucket: Bucket | None, shape: Shape, history: list[Totals], asked: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """For each (hashes, sizes, contexts) asked: (training count of each word, log10 probability of each pair)."""
    places, out = [], []
    hashes = bucket.hashes if bucket else np.zeros(0, np.uint64)
    keys = (bucket.word << 32) | bucket.ctx if bucket else np.zeros(0, np.int64)
    counts = np.bincount(bucket.word, weights=bucket.c, minlength=len(hashes)).astype(np.int64) if bucket else np.zeros(0, np.int64)

    def find(sorted_, x):
        at = np.minimum(np.searchsorted(sorted_, x), max(len(sorted_) - 1, 0))
        return np.where(sorted_[at] == x, at, len(sorted_)) if len(sorted_) else np.zeros(len(x), np.int64)

    for h, sizes, ctx in asked:
        word = find(hashes, h)
        pair_word = np.repeat(word, sizes)
        places.append((word, pair_word, find(keys, (pair_word << 32) | ctx), ctx.astype(np.int64)))
    sums = [np.zeros(len(p[1])) for p in places]
    steps = bucket.replay(shape, history[:-1]) if bucket else (None for _ in history[:-1])
    for k, state in enumerate(steps):
        if k < BURN_IN:
            continue
        totals = history[k + 1]
        unknown = (THETA_ROOT + shape.root_discount * totals.root_tables) * shape.base / (THETA_ROOT + totals.customers)
        root = np.append(state.root_p(shape, totals) if state else np.zeros(0), unknown)
        left = np.append(state.c - shape.discount * state.t, 0.0) if state else np.zeros(1)
        for j, (_, pair_word, pair, ctx) in enumerate(places):
            room = (left[pair] + (THETA + shape.discount * totals.tables[ctx]) * root[pair_word]) / (THETA + shape.customers[ctx])
            sums[j] += np.where(ctx > 0, room, root[pair_word])
    for (word, *_), s in zip(places, sums):
        out.append((np.append(counts, 0)[word], np.log10(s / KEPT)))
    return out


_ANSWER = "unit long, path string, bucket int, counts binary, logs binary"


def _answer(shape: Shape, rooms: Rooms):
    def run(batches):
        kept = range(BURN_IN, BURN_IN + KEPT)
        for batch in batches:
            for row in batch.to_pylist():
                bucket = Bucket.load(row)
                bucket.seated = {k + 1: rooms.seat(bucket, k) if k in kept else (bucket.t, bucket.root_t) for k in range(BURN_IN + KEPT)}
                history = [rooms.totals(bucket.number, k) if k - 1 in kept else None for k in range(BURN_IN + KEPT + 1)]
                hashes, *asked = _read(row["asked"])
                asked = [(hashes[w], sizes, ctx) for w, sizes, ctx in zip(asked[::3], asked[1::3], asked[2::3])]
                got = probabilities(bucket, rooms.shape(bucket.number, shape), history, asked)
                for unit, path, (counts, logs) in zip(row["units"], row["paths"], got):
                    yield pa.RecordBatch.from_arrays([pa.array([unit]), pa.array([path]), pa.array([bucket.number], pa.int32()), pa.array([_packed(counts)], pa.binary()),
                                                      pa.array([_packed(logs.astype(np.float32))], pa.binary())], names=["unit", "path", "bucket", "counts", "logs"])
        tidy()
    return run


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _add_up(train_tokens: int, vocabulary: int):
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["bucket"])
        with open_in(rows[0]["path"]) as f:
            unit = Unit.load(f)
        counts = np.concatenate([_unpacked(r["counts"], np.int64) for r in rows])[unit.tokens]
        _, which = unit.pairs()
        logs = np.concatenate([_unpacked(r["logs"], np.float32) for r in rows]).astype(np.float64)[which]
        first = np.cumsum(unit.lengths) - unit.lengths
        base = np.log10((counts + 1) / (train_tokens + vocabulary + 1))
        return pa.table({"doc_id": pa.array(unit.ids, pa.int64()), "held_out": pa.array(~unit.train), "n_tokens": pa.array(unit.lengths),
                         "n_known": pa.array(np.add.reduceat((counts > 0).astype(np.int64), first)), "train_tokens": pa.array([train_tokens] * len(unit.ids), pa.int64()),
                         "base_score": pa.array(np.add.reduceat(base, first)), "score": pa.array(np.add.reduceat(logs, first))})
    return run


def score_texts(docs: DataFrame, folds: int = 7, left_out: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    ship_code(docs.sparkSession)
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("t"))
    units = written(rows.mapInArrow(_unit_writer(scratch_path(spark, "units"), folds, left_out), _UNITS), "unit-list")
    n, entries, files = units.agg(F.sum("train_tokens"), F.sum("entries"), F.count(F.lit(1))).first()
    if not files:
        return spark.createDataFrame([], _SCORES)
    buckets = max(LEAST_BUCKETS, entries // BUCKET_ENTRIES + 1)

    listed = units.select("unit", "path").repartition(files, "unit")
    model = written(listed.mapInArrow(_requests(buckets), _REQUEST).groupBy("bucket").applyInArrow(_merger(scratch_path(spark, "pairs-files")), _MODEL), "pairs").repartition(buckets)
    shape, rooms = fit(model, buckets)
    answers = model.mapInArrow(_answer(shape, rooms), _ANSWER)
    return answers.groupBy("unit").applyInArrow(_add_up(n, shape.vocabulary), _SCORES)
