"""Language identification with interpolated Kneser-Ney character models.

One model per language over the letters of words, ``ORDER`` characters deep,
each word set between a start and an end mark.  Interpolated probabilities and
back-off weights are stored in sorted arrays of 64-bit n-gram hashes and found
by binary search.  A text gets the language with the lowest cross-entropy per
character; as a word's probability depends on the word alone, each distinct
word is looked up once per worker.

Counts, counts of counts, continuation counts, discounts and probabilities are
Spark tables over every n-gram of every training text.  The arrays are files in the
shared folder, cut by ranges of the hash; the driver holds one key a block, and a task
reads the blocks that its words need and keeps ``CACHE_BYTES`` of them, so the models
may grow with the corpus.

Two sets of models come out of one pass: from all training texts, which answer, and from all but
every tenth, which read that tenth to calibrate: the
margin between the best two languages gives the score (share of correct
answers among calibration texts of such a margin), and the cross-entropy that
99.5 % of a language's calibration texts stay below gives its rejection limit.
A rejected text keeps its best language, has ``rejected`` set and half the score.

Cases: a text that is null or has no letter gives ``und`` and score 0; texts
with a null language or a null id are not learnt from in the first case and are
in the second (the class of an empty id); equal cross-entropies go to the first
language by name; without any training text every answer is ``und``; repeated
rows are learnt from as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, OrderedDict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import remainder, ship_code, written
from contrail.llm.files import attempt_name, open_in, open_out
from contrail.session import scratch_path

ORDER = 4
START, END = "\x02", "\x03"
WORD_CACHE = 400_000
LONGEST = 64  # longer words are scored whole but not remembered
BLOCK = 1 << 15  # n-grams read from a model file at a time
CACHE_BYTES = 128 << 20
MARGINS = np.array([0.25, 0.5, 1, 2, 4, 8, 16, 32, 64])  # nats between the best two languages
CE_STEP = 0.05

_LETTERS = re.compile(r"[^\W\d_]+")
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def grams_of(word: str) -> list[str]:
    """The longest n-gram that ends at each character, at most ORDER deep."""
    w = START + word + END
    return [w[max(0, i - ORDER) : i] for i in range(2, len(w) + 1)]


def _count(batches):
    """(lang, cal, gram, n) of a partition; words first, so that each distinct word is cut up once."""
    words, grams, held = {}, {}, 0

    def cut():
        for key, counts in words.items():
            into = grams.setdefault(key, Counter())
            for w, n in counts.items():
                for g in grams_of(w):
                    into[g] += n
        words.clear()

    def rows():
        for (lang, cal), counts in grams.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array([cal] * len(counts), pa.bool_()),
                                              pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "cal", "gram", "n"])
        grams.clear()

    for batch in batches:
        for lang, cal, text in zip(batch.column("lang").to_pylist(), batch.column("cal").to_pylist(), batch.column("text")):
            counts = words.setdefault((lang, cal), Counter())
            before = len(counts)
            found = words_of(text.as_py())
            counts.update(found)
            held += len(counts) - before + sum(len(w) // LONGEST for w in found)
            if held > 300_000:
                cut()
                held = 0
                if sum(map(len, grams.values())) > 1_000_000:
                    yield from rows()
    cut()
    yield from rows()


def hashes(codes: np.ndarray, depth: int) -> list[np.ndarray]:
    """[k - 1][i]: hash of the k characters that end at i, for k up to ``depth`` (wrong where i < k - 1)."""
    out, h = [], np.zeros(len(codes), np.uint64)
    c = codes.astype(np.uint64) + np.uint64(1)
    for k in range(depth):
        h = h.copy()
        h[k:] += c[: len(c) - k] * _MULT[k]
        mixed = (h ^ (h >> np.uint64(31))) * _MULT[-1]
        out.append(mixed ^ (mixed >> np.uint64(29)))
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def kneser_ney(counts: dict[str, int], alphabet: int) -> tuple[list[dict], list[dict], float]:
    """([k - 1] {gram: log p}, [k - 1] {context: log back-off}, log p of an unseen character) of counts in memory."""
    levels = [Counter() for _ in range(ORDER + 1)]
    for g, n in counts.items():
        levels[len(g)][g] += n
    for k in range(ORDER - 1, 0, -1):  # a shorter n-gram counts its distinct left neighbours
        for g in levels[k + 1]:
            levels[k][g[1:]] += 1
    probs, backs, unseen = [], [], 1 / alphabet
    lower = {}
    for k in range(1, ORDER + 1):
        n1 = sum(1 for n in levels[k].values() if n == 1)
        n2 = sum(1 for n in levels[k].values() if n == 2)
        discount = min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5
        total, kinds = Counter(), Counter()
        for g, n in levels[k].items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        gamma = {c: discount * kinds[c] / total[c] for c in total}
        if k == 1 and "" in gamma:
            unseen = gamma[""] / alphabet
        here = {}
        for g, n in levels[k].items():
            c = g[:-1]
            rest = lower.get(g[1:], unseen) if k > 1 else 1 / alphabet
            here[g] = max(n - discount, 0) / total[c] + gamma[c] * rest
        probs.append({g: float(np.log(p)) for g, p in here.items()})
        backs.append({c: float(np.log(x)) for c, x in gamma.items()})
        lower = here
    return probs, backs, float(np.log(unseen))


class Models:
    """All languages: per order a sorted hash array with one column of log probabilities per language (nan: not in it).

    This one is built from counts in memory; :class:`StoredModels` reads the arrays from files.
    """

    def __init__(self, counts: dict[str, dict[str, int]]):
        self.langs = sorted(counts)
        alphabet = len({ch for c in counts.values() for g in c for ch in g[-1:]}) + 1
        fitted = [kneser_ney(counts[lang], alphabet) for lang in self.langs]
        self.unseen = np.array([f[2] for f in fitted])
        self.probs = [self._array([f[0][k] for f in fitted], k + 1, np.nan) for k in range(ORDER)]
        self.backs = [None] + [self._array([f[1][k] for f in fitted], k, 0.0) for k in range(1, ORDER)]
        self.margin_scores, self.limits = None, None
        self.name = uuid.uuid4().hex

    def _array(self, tables: list[dict], size: int, empty: float):
        grams = sorted(set().union(*tables))
        h = hashes(_codes("".join(grams)), size)[size - 1][size - 1 :: size] if grams else np.zeros(0, np.uint64)
        order = np.argsort(h)
        values = np.full((len(grams), len(tables)), empty, np.float32)
        for j, t in enumerate(tables):
            values[:, j] = [t.get(g, empty) for g in grams]
        return h[order], values[order]

    def _rows(self, table, h: np.ndarray, empty: float) -> np.ndarray:
        """[hash, language]: the values of a table, ``empty`` where it has none."""
        keys, values = table
        out = np.full((len(h), len(self.langs)), empty, np.float32)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            found = keys[at] == h
            out[found] = values[at[found]]
        return out

    def word_scores(self, words: list[str]) -> np.ndarray:
        """[word, language]: log probability of the word's characters and its end."""
        text = "".join([START + w + END for w in words])
        codes, sizes = _codes(text), np.array([len(w) + 2 for w in words])
        first = np.cumsum(sizes) - sizes
        place = np.arange(len(codes)) - np.repeat(first, sizes)
        keep = np.flatnonzero(place > 0)
        h, depth = hashes(codes, ORDER), place[keep]
        out = self._rows(self.probs[0], h[0][keep], np.nan)
        out = np.where(np.isnan(out), self.unseen.astype(np.float32), out)
        for k in range(2, ORDER + 1):
            some = np.flatnonzero(depth >= k - 1)
            pos = keep[some]
            p = self._rows(self.probs[k - 1], h[k - 1][pos], np.nan)
            back = self._rows(self.backs[k - 1], h[k - 2][pos - 1], 0.0)
            out[some] = np.where(np.isnan(p), out[some] + back, p)
        return np.add.reduceat(out.astype(np.float64), first - np.arange(len(words)))


class Blocks:
    """A sorted hash array in files: the first key of every block here, the blocks read when they are asked for."""

    _cache: OrderedDict = OrderedDict()  # of this worker: (file, block) -> (keys, values)
    _held = 0

    def __init__(self, files: list[tuple[str, int, list[int]]], width: int):
        """``files``: (path, keys in it, first key of each of its blocks), ascending."""
        self.width, self.paths = width, [(path, n) for path, n, _ in files]
        self.firsts = np.array([k for *_, firsts in files for k in firsts], np.int64).view(np.uint64)
        self.places = [(i, at * BLOCK) for i, (*_, firsts) in enumerate(files) for at in range(len(firsts))]

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        file, start = self.places[number]
        path, n = self.paths[file]
        key, cache = (path, start), Blocks._cache
        if key in cache:
            cache.move_to_end(key)
            return cache[key]
        rows = min(BLOCK, n - start)
        with open_in(path) as f:
            f.seek(8 * start)
            keys = np.frombuffer(f.read(8 * rows), np.uint64)
            f.seek(8 * n + 4 * self.width * start)
            values = np.frombuffer(f.read(4 * self.width * rows), np.float32).reshape(rows, self.width)
        cache[key] = keys, values
        Blocks._held += keys.nbytes + values.nbytes
        while Blocks._held > CACHE_BYTES and len(cache) > 1:
            _, (k, v) = cache.popitem(last=False)
            Blocks._held -= k.nbytes + v.nbytes
        return keys, values


class StoredModels(Models):
    """The models of files; only the first keys of the blocks are held."""

    def __init__(self, langs: list[str], unseen: np.ndarray, tables: dict[int, Blocks]):
        self.langs, self.unseen = langs, unseen
        self.probs = [tables.get(k) for k in range(1, ORDER + 1)]
        self.backs = [None] + [tables.get(ORDER + k) for k in range(1, ORDER)]
        self.margin_scores, self.limits = None, None
        self.name = uuid.uuid4().hex

    def _rows(self, table: Blocks | None, h: np.ndarray, empty: float) -> np.ndarray:
        out = np.full((len(h), len(self.langs)), empty, np.float32)
        if table is None or not len(table.firsts):
            return out
        block = np.searchsorted(table.firsts, h, "right") - 1
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(block[order]) != 0])
        for lo, hi in zip(cuts, np.r_[cuts[1:], len(order)]):
            mine, number = order[lo:hi], int(block[order[lo]])
            if number < 0:
                continue  # before the first key
            keys, values = table.block(number)
            at = np.minimum(np.searchsorted(keys, h[mine]), len(keys) - 1)
            found = keys[at] == h[mine]
            got = values[at[found]]
            out[mine[found]] = np.where(np.isnan(got), np.float32(empty), got)
        return out


class Reader:
    """Scores texts, keeping the scores of words already seen by this worker."""

    _shared: dict[str, Reader] = {}

    def __init__(self, models: Models):
        self.models, self.number, self.scores = models, {}, None

    @classmethod
    def of(cls, name: str, models: Models) -> Reader:
        if name not in cls._shared:
            cls._shared.clear()
            cls._shared[name] = cls(models)
        return cls._shared[name]

    def read(self, texts: list[str | None]) -> list[tuple | None]:
        """(language number, cross-entropy, nats to the second best) or None for each text."""
        if self.scores is not None and len(self.scores) > WORD_CACHE:
            self.number, self.scores = {}, None
        split = [words_of(t) if t else [] for t in texts]
        split = [s if any(c.isalpha() for w in s for c in w) else [] for s in split]
        new = list({w for s in split for w in s if w not in self.number})
        if new:
            got = np.column_stack([self.models.word_scores(new), [len(w) + 1 for w in new]])
            had = 0 if self.scores is None else len(self.scores)
            self.scores = got if self.scores is None else np.concatenate([self.scores, got])
            self.number.update(zip(new, range(had, had + len(new))))
        out = []
        for s in split:
            if not s:
                out.append(None)
                continue
            sums = self.scores[np.fromiter(map(self.number.__getitem__, s), np.int64, len(s))].sum(0)
            loss = -sums[:-1]
            best = int(loss.argmin())
            gap = float(np.partition(loss, 1)[1] - loss[best]) if len(loss) > 1 else np.inf
            out.append((best, float(loss[best] / sums[-1]), gap))
        for w in new:
            if len(w) > LONGEST:
                del self.number[w]
        return out


def _read_batches(name: str, models: Models, finish):
    def run(batches):
        reader = Reader.of(name, models)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield finish(part, reader.read(part.column("text").to_pylist()))
    return run


def _calibration_batch(langs: list[str]):
    def finish(part, got):
        known = [(lang, g) for lang, g in zip(part.column("lang").to_pylist(), got) if g]
        return pa.RecordBatch.from_arrays([
            pa.array([langs[g[0]] for _, g in known], pa.string()), pa.array([langs[g[0]] == lang for lang, g in known], pa.bool_()),
            pa.array([int(np.searchsorted(MARGINS, g[2])) for _, g in known], pa.int32()), pa.array([min(400, int(g[1] / CE_STEP)) for _, g in known], pa.int32())],
            names=["lang", "right", "margin", "ce"])
    return finish


def _rising(right: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Smoothed shares made non-decreasing by pooling neighbours."""
    pools = [[r + 1.0, m + 2.0, 1] for r, m in zip(right, n)]
    i = 0
    while i < len(pools) - 1:
        if pools[i][0] / pools[i][1] > pools[i + 1][0] / pools[i + 1][1]:
            pools[i] = [a + b for a, b in zip(pools[i], pools.pop(i + 1))]
            i = max(0, i - 1)
        else:
            i += 1
    return np.concatenate([np.full(p[2], p[0] / p[1]) for p in pools])


def _discounts(level: DataFrame) -> DataFrame:
    """(model, lang, d): the discount of an order from its counts of counts; one row per language."""
    ones, twos = (F.sum((F.col("n") == i).cast("long")).cast("double") for i in (1, 2))
    counts = level.groupBy("model", "lang").agg(ones.alias("n1"), twos.alias("n2"))
    share = F.greatest(F.lit(0.1), F.least(F.lit(0.95), F.col("n1") / (F.col("n1") + 2 * F.col("n2"))))
    return counts.select("model", "lang", F.when(F.col("n1") + F.col("n2") > 0, share).otherwise(0.5).alias("d"))


_TABLES = "model int, t int, key long, at int, value float"


def _hash_rows(langs: list[str]):
    """Grams as hashes, in an order that signed numbers keep, and languages as numbers."""
    number = {lang: i for i, lang in enumerate(langs)}

    def run(batches):
        for batch in batches:
            grams, t = batch.column("gram").to_pylist(), batch.column("t").to_numpy()
            sizes = np.array([len(g) for g in grams], np.int64)
            keys = np.zeros(len(grams), np.uint64)
            for size in np.unique(sizes):
                some = np.flatnonzero(sizes == size)
                keys[some] = hashes(_codes("".join([grams[i] for i in some])), int(size))[size - 1][size - 1 :: size]
            yield pa.RecordBatch.from_arrays([batch.column("model"), pa.array(t), pa.array((keys ^ _SIGN).view(np.int64)),
                                              pa.array([number[x] for x in batch.column("lang").to_pylist()], pa.int32()), batch.column("value")],
                                             names=["model", "t", "key", "at", "value"])
    return run


_SIGN = np.uint64(1 << 63)
_FILES = "model int, t int, path string, n long, firsts array<long>"


def _array_writer(folder: str, width: int):
    """One file a task and table: the sorted keys, then a row of values for each."""
    schema = pa.schema([("model", pa.int32()), ("t", pa.int32()), ("path", pa.string()), ("n", pa.int64()), ("firsts", pa.list_(pa.int64()))])

    def save(pid, model, t, keys, at, values):
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        rows = np.full((len(new), width), np.nan, np.float32)
        rows[np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(keys)])), at] = values
        mine = keys[new].view(np.uint64) ^ _SIGN
        path = attempt_name(folder, pid, ".grams")
        with open_out(path) as f:
            f.write(mine.tobytes())
            f.write(rows.tobytes())
        return {"model": [model], "t": [t], "path": [path], "n": [len(mine)], "firsts": [mine[::BLOCK].view(np.int64).tolist()]}

    def run(batches):
        pid, held, key = TaskContext.get().partitionId(), [], None
        for batch in batches:
            table = np.stack([batch.column("model").to_numpy(), batch.column("t").to_numpy()], 1)
            cuts = np.flatnonzero(np.r_[True, (np.diff(table, axis=0) != 0).any(1)]) if len(table) else []
            for lo, hi in zip(cuts, np.r_[cuts[1:], len(table)] if len(table) else []):
                here = tuple(table[lo].tolist())
                if key is not None and here != key:
                    yield pa.RecordBatch.from_pydict(save(pid, *key, *map(np.concatenate, zip(*held))), schema=schema)
                    held = []
                key = here
                held.append(tuple(batch.column(c).to_numpy()[lo:hi] for c in ("key", "at", "value")))
        if held:
            yield pa.RecordBatch.from_pydict(save(pid, *key, *map(np.concatenate, zip(*held))), schema=schema)
    return run


def fit(counts: DataFrame) -> dict[int, StoredModels]:
    """The models of ``counts`` (model, lang, gram, n), every n-gram of each; estimated in Spark and stored as files."""
    spark = counts.sparkSession
    names: dict[int, list[str]] = {}
    for r in counts.select("model", "lang").distinct().collect():  # one row per language
        names.setdefault(r["model"], []).append(r["lang"])
    if not names:
        return {}
    names = {m: sorted(x) for m, x in names.items()}
    langs = sorted(set().union(*names.values()))
    alphabet = {r["model"]: r["a"] + 1 for r in counts.groupBy("model").agg(F.countDistinct(F.right("gram", F.lit(1))).alias("a")).collect()}
    letters = F.element_at(F.create_map(*[F.lit(x) for m, a in alphabet.items() for x in (m, float(a))]), F.col("model"))

    level, levels = counts.filter(F.length("gram") == ORDER).select("model", "lang", "gram", "n"), {}
    for k in range(ORDER, 0, -1):
        levels[k] = written(level, f"grams-{k}")
        # A shorter n-gram counts its distinct left neighbours; those at a word's start have none and keep their counts.
        left = levels[k].select("model", "lang", F.expr("substring(gram, 2)").alias("gram"), F.lit(1).cast("long").alias("n"))
        own = counts.filter(F.length("gram") == k - 1).select("model", "lang", "gram", "n")
        level = own.unionByName(left).groupBy("model", "lang", "gram").agg(F.sum("n").alias("n"))

    tables, lower, unseen = None, None, {}
    for k in range(1, ORDER + 1):
        g = levels[k].withColumn("c", F.expr(f"substring(gram, 1, {k - 1})"))
        contexts = g.groupBy("model", "lang", "c").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        contexts = written(contexts.join(F.broadcast(_discounts(levels[k])), ["model", "lang"])  # one row per language
                           .withColumn("gamma", F.col("d") * F.col("kinds") / F.col("total")), f"contexts-{k}")
        here = g.join(contexts.select("model", "lang", "c", "total", "d", "gamma"), ["model", "lang", "c"])
        if k == 1:
            unseen = {(r["model"], r["lang"]): r["gamma"] / alphabet[r["model"]] for r in contexts.collect()}  # one row per language
            rest = 1 / letters
        else:
            below = lower.select("model", "lang", F.col("gram").alias("_tail"), F.col("p").alias("_p"))
            here = here.withColumn("_tail", F.expr("substring(gram, 2)")).join(below, ["model", "lang", "_tail"], "left")
            chance = F.create_map(*[F.lit(x) for (m, lang), u in unseen.items() for x in (f"{m} {lang}", u)])
            rest = F.coalesce("_p", F.element_at(chance, F.concat_ws(" ", F.col("model").cast("string"), "lang")), 1 / letters)
        p = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("gamma") * rest
        lower = written(here.select("model", "lang", "gram", p.alias("p")), f"probabilities-{k}")
        rows = lower.select("model", F.lit(k).alias("t"), "lang", "gram", F.log("p").cast("float").alias("value"))
        if k > 1:
            backs = contexts.select("model", F.lit(ORDER + k - 1).alias("t"), "lang", F.col("c").alias("gram"), F.log("gamma").cast("float").alias("value"))
            rows = rows.unionByName(backs)
        tables = rows if tables is None else tables.unionByName(rows)

    hashed = tables.mapInArrow(_hash_rows(langs), _TABLES).repartitionByRange("model", "t", "key").sortWithinPartitions("model", "t", "key")
    folder = scratch_path(spark, "language-models")
    files = written(hashed.mapInArrow(_array_writer(folder, len(langs)), _FILES), "language-files").collect()  # a key for every block
    out = {}
    for model in names:
        mine = {}
        for r in files:
            if r["model"] == model:
                mine.setdefault(r["t"], []).append((r["path"], r["n"], r["firsts"]))
        ordered = {t: Blocks(sorted(x, key=lambda f: f[2][0] & (1 << 64) - 1), len(langs)) for t, x in mine.items()}
        rare = np.log(np.array([unseen.get((model, lang), 1 / alphabet[model]) for lang in langs]))
        rare[[lang not in names[model] for lang in langs]] = -1e3  # a language that this set has not learnt is never the best
        out[model] = StoredModels(langs, rare, ordered)
    return out


ANSWERS, CALIBRATES = 0, 1


def train(docs: DataFrame, folds: int = 3, left_out: int = 1) -> Models | None:
    """Models of the languages of the learnable rows of ``docs`` (crc32(doc_id) mod folds is not left_out)."""
    ship_code(docs.sparkSession)
    known = docs.select("doc_id", "text", "lang").filter("text is not null and lang is not null").filter(remainder(F.col("doc_id"), folds) != left_out)
    tenth = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(10)) == 0, F.lit(False))
    counted = known.select("lang", tenth.alias("cal"), "text").mapInArrow(_count, "lang string, cal boolean, gram string, n long")
    sums = written(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("cal"), F.col("n")).otherwise(0)).alias("cal_n")), "grams")
    every = sums.select(F.lit(ANSWERS).alias("model"), "lang", "gram", "n")
    models = fit(every.unionByName(sums.select(F.lit(CALIBRATES).alias("model"), "lang", "gram", (F.col("n") - F.col("cal_n")).alias("n")).filter("n > 0")))
    if not models:
        return None
    models, judge = models[ANSWERS], models.get(CALIBRATES, models[ANSWERS])
    seen = known.filter(tenth).select("lang", "text").mapInArrow(
        _read_batches(judge.name, judge, _calibration_batch(judge.langs)), "lang string, right boolean, margin int, ce int").groupBy("lang", "right", "margin", "ce").count().toPandas()
    n, right = np.zeros(len(MARGINS) + 1), np.zeros(len(MARGINS) + 1)
    np.add.at(n, seen["margin"].to_numpy(int), seen["count"])
    np.add.at(right, seen["margin"].to_numpy(int), seen["count"] * seen["right"])
    models.margin_scores = _rising(right, n)
    limits = []
    for lang in models.langs:
        own = seen[(seen["lang"] == lang) & seen["right"].astype(bool)].groupby("ce")["count"].sum().sort_index()
        limits.append(float((own.index[np.searchsorted(own.cumsum().to_numpy(), 0.995 * own.sum())] + 1) * CE_STEP) if len(own) else np.inf)
    models.limits = np.array(limits)
    return models


def identify(docs: DataFrame, models: Models | None) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, rejected."""
    ship_code(docs.sparkSession)
    if models is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("rejected"))

    langs, margin_scores, limits, margins = models.langs, models.margin_scores, models.limits, MARGINS

    def finish(part, got):
        lang = [langs[g[0]] if g else "und" for g in got]
        out = [bool(g and g[1] > limits[g[0]]) for g in got]
        score = [float(margin_scores[np.searchsorted(margins, g[2])]) * (0.5 if r else 1.0) if g else 0.0 for g, r in zip(got, out)]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(out, pa.bool_())],
                                          names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _read_batches(models.name, models, finish), "doc_id long, lang_pred string, score double, rejected boolean")


def languages(docs: DataFrame, folds: int = 3, left_out: int = 1) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""
    out = identify(docs, train(docs, folds, left_out))
    return out.select("doc_id", (remainder(F.col("doc_id"), folds) == left_out).alias("held_out"), "lang_pred", "score", "rejected")
