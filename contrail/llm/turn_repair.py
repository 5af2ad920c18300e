"""Conversation structure repair by a run-length dynamic programme.

Every row of a conversation becomes a symbol: the initial of its role (``s``,
``u``, ``a`` or another) and its fault (must be deleted, truncated, none).  The
programme has four states, the end of what has been written so far: nothing, a
system turn, a user turn, an assistant turn.  The cost of going from one state
to another over one symbol is a 4 x 4 min-plus matrix; equal consecutive
symbols are one run, and a run of n rows is passed with the cached binary powers
of its matrix.  The costs are carried from the end to the beginning; then the
choices are unrolled from the beginning, the ASCII-least of the cheapest each time.
A repaired conversation has the role initials ``(s?(ua)+)?``.

How it is dealt out.  Texts stay behind: a row is reduced to its turn, role,
digest of the text and fault, equal rows to one with a count.  These are
range-partitioned and sorted, so a conversation of any length is cut between
tasks; each task answers the conversations it holds whole, and gives matrices and
runs for the first and the last one, at most two rows a task, which are put
together by conversation and then unrolled piece by piece.  Last, texts and
audits meet, sorted by conversation and turn, and pass by as a stream into the
hash of the repaired conversation; a SHA-256 has no partial results, so the
texts of one conversation go through one task, never held in it.

Cases: null roles and texts are one space, null ids and turns are a space in the
crc32; null ids are a conversation of their own, null turns come first.  Rows of
one turn are ordered by role and SHA-256 of the text.  A role counts by
its first character; an empty role has no initial and is never kept.  Repeated rows count
one by one.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import attach, ship_code, written

INF = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)        # where a rerole or an insert leads: user, or assistant after user
ROLE = {USER: b"user", ASSISTANT: b"assistant"}
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
GOAL = tuple(0 if i in (START, ASSISTANT) else INSERT if i == USER else 2 * INSERT for i in range(4))  # inserts at the end included
WHITE = " \t\n\x0b\x0c\r"
BLANK, CUT, FINE = 0, 1, 2                  # what the text of a row is
GONE = ("-", BLANK)                         # symbol of a row that must be deleted

Symbol = tuple[str, int]
Matrix = tuple[tuple[int, ...], ...]


def moves(symbol: Symbol, i: int) -> list[tuple[str, int, int]]:
    """(audit letter, cost, next state) of the edits that consume one row in state ``i``, letters ascending."""
    initial, fault = symbol
    out = [("D", DELETE, i)]
    if fault != BLANK:
        more = TRUNCATED if fault == CUT else 0
        if i in KEPT.get(initial, {}):
            out.append(("K", KEEP + more, KEPT[initial][i]))
        out.append(("R", REROLE + more, NEXT[i]))
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def apply(a: Matrix, v: tuple[int, ...]) -> tuple[int, ...]:
    return tuple([min(a[i][k] + v[k] for k in range(4)) for i in range(4)])


UNIT: Matrix = tuple(tuple(0 if i == j else INF for j in range(4)) for i in range(4))


@lru_cache(maxsize=None)
def step(symbol: Symbol) -> Matrix:
    """Min-plus matrix of one row, inserts before it included (nine symbols in all)."""
    inserts = [[INF] * 4 for _ in range(4)]
    for i in range(4):
        j, cost = i, 0
        while cost < inserts[i][j]:
            inserts[i][j] = cost
            j, cost = NEXT[j], cost + INSERT
    row = [[INF] * 4 for _ in range(4)]
    for i in range(4):
        for _, cost, j in moves(symbol, i):
            row[i][j] = min(row[i][j], cost)
    return times(tuple(map(tuple, inserts)), tuple(map(tuple, row)))


@lru_cache(maxsize=None)
def power(symbol: Symbol, k: int) -> Matrix:
    """The matrix of 2^k equal rows."""
    return step(symbol) if k == 0 else times(power(symbol, k - 1), power(symbol, k - 1))


def before(symbol: Symbol, n: int, v: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go ahead of a run of ``n`` rows, from those behind it."""
    k = 0
    while n:
        if n & 1:
            v = apply(power(symbol, k), v)
        n, k = n >> 1, k + 1
    return v


def run_matrix(symbol: Symbol, n: int) -> Matrix:
    out, k = UNIT, 0
    while n:
        if n & 1:
            out = times(power(symbol, k), out)
        n, k = n >> 1, k + 1
    return out


_SHORT = 64


def _unroll_run(symbol: Symbol, n: int, state: int, behind: tuple[int, ...], out: list[str]) -> int:
    """Append the choices of a run to ``out``; returns the state behind it."""
    while n > _SHORT:  # halves of a power of two: the costs in the middle come from one cached matrix
        k = (n - 1).bit_length() - 1
        state = _unroll_run(symbol, n - (1 << k), state, apply(power(symbol, k), behind), out)
        n = 1 << k
        if n > _SHORT:
            state = _unroll_run(symbol, n >> 1, state, apply(power(symbol, k - 1), behind), out)
            n >>= 1
    costs = [behind]
    for _ in range(n):
        costs.append(apply(step(symbol), costs[-1]))
    for left in range(n, 0, -1):
        here, after = costs[left], costs[left - 1]
        while True:
            options = moves(symbol, state)
            letter, _, to = next(((c, w, j) for c, w, j in options if c == "D" and w + after[j] == here[state]), ("", 0, 0))
            if not letter and INSERT + here[NEXT[state]] == here[state]:
                out.append("I")
                state = NEXT[state]
                continue
            if not letter:
                letter, _, to = next((c, w, j) for c, w, j in options if w + after[j] == here[state])
            out.append(letter)
            state = to
            break
    return state


def costs_to_go(runs, end: tuple[int, ...] = GOAL) -> list[tuple[int, ...]]:
    """Cost vectors before every run and behind the last one."""
    costs = [end]
    for symbol, n in reversed(runs):
        costs.append(before(symbol, n, costs[-1]))
    return costs[::-1]


def unroll(runs, state: int, end: tuple[int, ...], last: bool = True) -> str:
    """The audit of ``runs`` from ``state``, where ``end`` are the costs behind them."""
    costs, out = costs_to_go(runs, end), []
    for (symbol, n), behind in zip(runs, costs[1:]):
        state = _unroll_run(symbol, n, state, behind, out)
    while last and state not in (START, ASSISTANT):
        out.append("I")
        state = NEXT[state]
    return "".join(out)


@lru_cache(maxsize=1 << 14)
def _answer(runs: tuple) -> tuple[int, str]:
    return costs_to_go(runs)[0][START], unroll(runs, START, GOAL)


def repair(runs) -> tuple[int, str]:
    """(cost, audit) of a whole conversation given as runs ((symbol, rows), ...)."""
    return _answer(tuple(runs)) if len(runs) <= 16 else (costs_to_go(runs)[0][START], unroll(runs, START, GOAL))


def matrix_of(runs) -> Matrix:
    out = UNIT
    for symbol, n in runs:
        out = times(out, run_matrix(symbol, n))
    return out


# ----------------------------------------------------------------------------- rows in Spark


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): the damaged rows; ``n`` says how often the row is there, 0 for dropped ones."""
    space = F.lit(" ")
    text, role = F.coalesce(F.col("text"), space), F.coalesce(F.col("role"), space)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("n"))


def _fault(text: Column) -> Column:
    bare = F.rtrim(text, F.lit(WHITE))
    return F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(CUT)


_SIZES = "blank long, duplicate long, truncated long, illegal long"
_PIECE = (f"conv_id long, pid int, at int, edge boolean, {_SIZES}, rows long, lo long, hi long, turns long, "
          "first string, last string, cost long, audit string, matrix array<long>, runs binary")
_ORDER = ["conv_id", "turn", "role", "digest"]
_LEGAL = {"su", "ua", "au"}
_CODES = [GONE, *((r, f) for r in "sua?" for f in (CUT, FINE))]
_CODE = {s: i for i, s in enumerate(_CODES)}


def _pack(runs) -> bytes:
    """One byte for the symbol, eight for the length."""
    return b"".join(bytes([_CODE[s]]) + n.to_bytes(8, "little") for s, n in runs)


def _unpack(raw: bytes):
    return [(_CODES[raw[i]], int.from_bytes(raw[i + 1 : i + 9], "little")) for i in range(0, len(raw), 9)]


class _Piece:
    """What a task gathers of one conversation."""

    def __init__(self, conv):
        self.conv, self.runs = conv, []
        self.faults, self.illegal, self.rows = [0, 0, 0], 0, 0
        self.lo = self.hi = self.seen = None
        self.turns, self.first, self.last = 0, None, None

    def add(self, turn, role, fault, n, fresh) -> None:
        if not n:
            return
        initial = role[:1]
        copies = 0 if fault == BLANK else n - 1 if fresh else n
        if fault == BLANK:
            parts = [(GONE, n)]
            self.faults[0] += n
        else:
            parts = [((initial if initial in "sua" and initial else "?", fault), n - copies), (GONE, copies)]
            self.faults[1] += copies
            self.faults[2] += n - copies if fault == CUT else 0
        for symbol, k in parts:
            if k and self.runs and self.runs[-1][0] == symbol:
                self.runs[-1] = (symbol, self.runs[-1][1] + k)
            elif k:
                self.runs.append((symbol, k))
        if self.last is not None and self.last + initial not in _LEGAL:
            self.illegal += 1
        self.illegal += n - 1  # copies of a row stand next to each other, and no legal pair has equal initials
        self.first, self.last = initial if self.first is None else self.first, initial
        self.rows += n
        if turn is not None:
            if turn != self.hi:
                self.turns += 1
            self.lo, self.hi = turn if self.lo is None else self.lo, turn

    def row(self, pid, at, edge) -> dict:
        out = {"conv_id": self.conv, "pid": pid, "at": at, "edge": edge, "blank": self.faults[0], "duplicate": self.faults[1],
               "truncated": self.faults[2], "illegal": self.illegal, "rows": self.rows, "lo": self.lo, "hi": self.hi, "turns": self.turns,
               "first": self.first, "last": self.last, "cost": None, "audit": None, "matrix": None, "runs": None}
        if edge:
            out |= {"matrix": [x for r in matrix_of(self.runs) for x in r], "runs": _pack(self.runs)}
        else:
            out["cost"], out["audit"] = repair(self.runs)
        return out


_ARROW = pa.schema([("conv_id", pa.int64()), ("pid", pa.int32()), ("at", pa.int32()), ("edge", pa.bool_()), ("blank", pa.int64()),
                    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("rows", pa.int64()), ("lo", pa.int64()),
                    ("hi", pa.int64()), ("turns", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("cost", pa.int64()),
                    ("audit", pa.string()), ("matrix", pa.list_(pa.int64())), ("runs", pa.binary())])


def _gather(batches):
    """Conversations of one sorted partition; the first and the last one may go on in another task."""
    pid, piece, at, out = TaskContext.get().partitionId(), None, 0, []
    for batch in batches:
        for conv, turn, role, fault, n, fresh in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "fault", "n", "fresh")]):
            if piece is None or conv != piece.conv:
                if piece is not None:
                    out.append(piece.row(pid, at, at == 0))
                    at += 1
                piece = _Piece(conv)
            piece.add(turn, role, fault, n, fresh)
        if len(out) >= 1024:
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
            out = []
    if piece is not None:
        out.append(piece.row(pid, at, True))
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_ARROW)


def _gaps(lo, hi, turns) -> int:
    return 0 if lo is None else hi - lo + 1 - turns


_PLAN = f"conv_id long, pid int, at int, state int, behind array<long>, last boolean, gaps long, {_SIZES}, cost long"


def _join_pieces(group: pa.Table) -> pa.Table:
    """State before and costs behind every piece of one conversation (one matrix a piece), and the sums of the whole."""
    rows = sorted(group.to_pylist(), key=lambda r: (r["pid"], r["at"]))
    behind, costs = [], GOAL
    for r in reversed(rows):
        behind.append(costs)
        m = r["matrix"]
        costs = apply(tuple(tuple(m[4 * i : 4 * i + 4]) for i in range(4)), costs)
    behind.reverse()
    lo = hi = last = None
    turns = illegal = 0
    for r in rows:
        if r["rows"]:
            illegal += r["illegal"] + (last is not None and last + r["first"] not in _LEGAL)
            last = r["last"]
        if r["lo"] is not None:
            turns += r["turns"] - (r["lo"] == hi)
            lo, hi = r["lo"] if lo is None else lo, r["hi"]
    whole = {"gaps": _gaps(lo, hi, turns), "illegal": illegal, "cost": costs[START],
             **{c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated")}}
    out, state = [], START
    for r, b in zip(rows, behind):
        final = r is rows[-1]
        out.append({"conv_id": r["conv_id"], "pid": r["pid"], "at": r["at"], "state": state, "behind": list(b), "last": final, **whole})
        state = _leave(r["matrix"], state, b)
    schema = pa.schema([("conv_id", pa.int64()), ("pid", pa.int32()), ("at", pa.int32()), ("state", pa.int32()), ("behind", pa.list_(pa.int64())),
                        ("last", pa.bool_()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
                        ("illegal", pa.int64()), ("cost", pa.int64())])
    return pa.Table.from_pylist(out, schema=schema)


def _leave(matrix, state, behind) -> int | None:
    """The one state in which every cheapest way leaves a piece, or -1 when ties must be unrolled to tell."""
    best = min(matrix[4 * state + j] + behind[j] for j in range(4)) if state >= 0 else None
    ways = [j for j in range(4) if matrix[4 * state + j] + behind[j] == best] if state >= 0 else []
    return ways[0] if len(ways) == 1 else -1


_AUDIT = "conv_id long, pid int, at int, starts int, leaves int, audit string"


def _unroll_pieces(batches):
    """The audit of each piece from every state it may start in, and the state it leaves in.

    A tie can leave a piece in several states; which one the ASCII-least audit
    takes depends on the state before, so a piece behind a tie is unrolled from all four.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("pid", pa.int32()), ("at", pa.int32()), ("starts", pa.int32()), ("leaves", pa.int32()), ("audit", pa.string())])
    for batch in batches:
        for r in batch.to_pylist():
            runs, behind, out = _unpack(r["runs"]), tuple(r["behind"]), []
            for state in range(4) if r["state"] < 0 else [r["state"]]:
                if costs_to_go(runs, behind)[0][state] >= INF:
                    continue
                audit = unroll(runs, state, behind, last=r["last"])
                out.append({"conv_id": r["conv_id"], "pid": r["pid"], "at": r["at"], "starts": state, "leaves": walk(audit, runs, state), "audit": audit})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)


def walk(audit: str, runs, state: int) -> int:
    """The state behind an audit."""
    symbols = (s for s, n in runs for _ in range(n))
    for c in audit:
        if c == "I":
            state = NEXT[state]
        else:
            initial, _ = next(symbols)
            state = state if c == "D" else NEXT[state] if c == "R" else KEPT[initial][state]
    return state


def _chain(group: pa.Table) -> pa.Table:
    """The pieces of one audit in order, each from the state in which the one before left."""
    by: dict = {}
    for r in group.to_pylist():
        by.setdefault((r["pid"], r["at"]), {})[r["starts"]] = r
    state, parts, conv = START, [], None
    for key in sorted(by):
        r = by[key][state]
        state, conv = r["leaves"], r["conv_id"]
        parts.append(r["audit"])
    return pa.table({"conv_id": pa.array([conv], pa.int64()), "audit": pa.array(["".join(parts)], pa.string())})


_HASHED = f"conv_id long, gaps long, {_SIZES}, cost long, audit string, repaired_sha256 string"
_HASHED_ARROW = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                           ("audit", pa.string()), ("repaired_sha256", pa.string())])


class _Hash:
    """SHA-256 of one repaired conversation while its rows pass by."""

    def __init__(self, head):
        self.head, self.sha, self.state, self.at, self.lines = head, hashlib.sha256(), START, 0, 0

    def line(self, role: bytes, text: bytes) -> None:
        self.sha.update((b"\n" if self.lines else b"") + role + b":")
        self.sha.update(text)
        self.lines += 1

    def inserts(self) -> None:
        audit = self.head["audit"]
        while self.at < len(audit) and audit[self.at] == "I":
            self.state = NEXT[self.state]
            self.line(ROLE[self.state], b"")
            self.at += 1

    def row(self, role: str, text: bytes, n: int) -> None:
        for _ in range(n):
            self.inserts()
            c = self.head["audit"][self.at]
            self.at += 1
            if c == "D":
                continue
            self.state = NEXT[self.state] if c == "R" else KEPT[role[0]][self.state]
            self.line(ROLE[self.state] if c == "R" else role.encode(), text)

    def done(self) -> dict:
        self.inserts()
        return self.head | {"repaired_sha256": self.sha.hexdigest()}


def _hash_rows(batches):
    one, out = None, []
    heads = [f.name for f in _HASHED_ARROW if f.name != "repaired_sha256"]
    for batch in batches:
        cols = {c: batch.column(c) for c in batch.schema.names}
        for i in range(batch.num_rows):
            if cols["audit"][i].is_valid:
                if one is not None:
                    out.append(one.done())
                one = _Hash({c: cols[c][i].as_py() for c in heads})
            else:
                one.row(cols["role"][i].as_py(), cols["text"][i].as_py(), cols["n"][i].as_py())
        if len(out) >= 1024:
            yield pa.RecordBatch.from_pylist(out, schema=_HASHED_ARROW)
            out = []
    if one is not None:
        out.append(one.done())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_HASHED_ARROW)


def _marked(rows: DataFrame) -> DataFrame:
    """One row per distinct (conversation, turn, role, text): its fault, its count, and whether it is the first with that role and text."""
    small = rows.select("conv_id", "turn", "role", "n", _fault(F.col("text")).alias("fault"), F.sha2("text", 256).alias("digest"))
    marks = written(small.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("n").alias("n")), "marks")
    same = F.sha2(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.col("digest"), F.col("role")), 256)
    keyed = marks.withColumn("same", same).withColumn("__row", F.concat_ws(":", F.col("turn").cast("string"), F.col("same")))
    # Turns ascend with nulls first, so a struct with "is known" ahead of the turn has the first one as its minimum.
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = keyed.filter("n > 0").groupBy("same").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("members"))
    facts = written(firsts, "firsts")
    total = marks.count()
    out = attach(keyed, facts, "same", "members", "__row", total)
    fresh = (F.col("first.known") == F.col("turn").isNotNull()) & F.col("first.turn").eqNullSafe(F.col("turn"))
    return out.select(*_ORDER, "fault", "n", F.coalesce(fresh, F.lit(False)).alias("fresh"))


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of damaged ``rows``: conv_id, gaps, faults, illegal, cost, audit."""
    ranged = _marked(rows).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    pieces = written(ranged.mapInArrow(_gather, _PIECE), "pieces")
    inside = pieces.filter("not edge").select("conv_id", F.when(F.col("lo").isNull(), 0).otherwise(F.col("hi") - F.col("lo") + 1 - F.col("turns")).alias("gaps"),
                                              "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    edges = pieces.filter("edge")  # at most two rows a task
    plan = written(edges.drop("runs", "cost", "audit", "edge").groupBy("conv_id").applyInArrow(_join_pieces, _PLAN), "plan")
    todo = edges.select("pid", "at", "runs").join(plan.select("conv_id", "pid", "at", "state", "behind", "last"), ["pid", "at"])
    parts = todo.mapInArrow(_unroll_pieces, _AUDIT).groupBy("conv_id").applyInArrow(_chain, "conv_id long, audit string")
    whole = plan.filter("last").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    joined = whole.join(parts.withColumnRenamed("conv_id", "__c"), F.col("conv_id").eqNullSafe(F.col("__c"))).drop("__c")
    return inside.unionByName(joined)


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation of damaged ``rows`` (conv_id, turn, role, text, n) with its audit and the hash of its repair."""
    ship_code(rows.sparkSession)
    heads = audits(rows)
    text = F.when(_fault(F.col("text")) == BLANK, F.lit("")).otherwise(F.col("text")).cast("binary")  # blank rows are always deleted
    body = rows.filter("n > 0").select("conv_id", "turn", "role", F.sha2("text", 256).alias("digest"), text.alias("text"), "n")
    both = heads.withColumn("head", F.lit(0)).unionByName(body.withColumn("head", F.lit(1)), allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "head", "turn", "role", "digest")
    return ordered.mapInArrow(_hash_rows, _HASHED)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Damage ``rows`` by the rule of :func:`damaged`, find the cheapest repair of every conversation and hash it."""
    return repaired(damaged(rows))
