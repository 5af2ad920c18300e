"""Conversation repair against a plain programme and a plain reading of the contract."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import turn_repair as tr
from contrail.llm.queries import op11_turn_repair


def plain(symbols):
    """(cost, audit): best of all ways, kept by state, symbol for symbol."""
    def with_inserts(best):
        for _ in range(3):
            for i, (c, a) in list(best.items()):
                better = (c + 5, a + "I")
                if better < best.get(tr.NEXT[i], (tr.INF, "")):
                    best[tr.NEXT[i]] = better
        return best

    best = {tr.START: (0, "")}
    for s in symbols:
        after = {}
        for i, (c, a) in with_inserts(best).items():
            for letter, w, j in tr.moves(s, i):
                after[j] = min(after.get(j, (tr.INF, "")), (c + w, a + letter))
        best = after
    return min(v for i, v in with_inserts(best).items() if i in (tr.START, tr.ASSISTANT))


def runs_of(symbols):
    out = []
    for s in symbols:
        if out and out[-1][0] == s:
            out[-1] = (s, out[-1][1] + 1)
        else:
            out.append((s, 1))
    return out


SYMBOLS = st.lists(st.tuples(st.sampled_from(tr._CODES), st.sampled_from([1, 1, 1, 2, 5, 90])), max_size=8).map(lambda x: [s for s, n in x for _ in range(n)])


@settings(max_examples=300, deadline=None)
@given(SYMBOLS)
def test_runs_give_what_single_steps_give(symbols):
    assert tr.repair(runs_of(symbols)) == plain(symbols)


@settings(max_examples=100, deadline=None)
@given(SYMBOLS, st.integers(0, 100))
def test_pieces_join(symbols, cut):
    cut = min(cut, len(symbols))
    one, two = runs_of(symbols[:cut]), runs_of(symbols[cut:])
    whole = tr.times(tr.matrix_of(one), tr.matrix_of(two))
    assert whole == tr.matrix_of(runs_of(symbols))
    assert tr.apply(whole, tr.GOAL)[tr.START] == plain(symbols)[0]


def test_cost_of_a_long_run():
    cost, audit = tr.repair([(tr.GONE, 1 << 17), (("u", tr.FINE), 1), (("a", tr.FINE), 1)])
    assert cost == 2 << 17 and audit == "D" * (1 << 17) + "KK"


def expected(rows):
    """The contract, row by row: {conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)}."""
    convs = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        convs.setdefault(conv, []).extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    out = {}
    for conv, got in convs.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, symbols, counts = set(), [], [0, 0, 0]
        for _, role, text in got:
            bare = text.strip(" \t\n\x0b\x0c\r")
            initial = role[0] if role and role[0] in "sua" else "?"
            if not bare or (role, text) in seen:
                counts[0 if not bare else 1] += 1
                symbols.append(tr.GONE)
            else:
                counts[2] += bare[-1] not in ".!?"
                symbols.append((initial, tr.FINE if bare[-1] in ".!?" else tr.CUT))
            seen.add((role, text))
        cost, audit = plain(symbols)
        state, lines, left = tr.START, [], list(got)
        for c in audit:
            if c == "I":
                state = tr.NEXT[state]
                lines.append(tr.ROLE[state].decode() + ":")
                continue
            _, role, text = left.pop(0)
            if c != "D":
                state = tr.NEXT[state] if c == "R" else tr.KEPT[role[0]][state]
                lines.append((role if c == "K" else tr.ROLE[state].decode()) + ":" + text)
        turns = [t for t, _, _ in got if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(got, got[1:]))
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def run(spark, rows, tmp_path, extra=True):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("n", "fault", "digest", "audit", "head", "same", "pid") if extra else ():
        df = df.selectExpr("*", f"'x' as `{c}`")
    df.write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    return {r.conv_id: tuple(r)[1:] for r in op11_turn_repair(spark, str(tmp_path)).collect()}


def test_edge_cases(spark, tmp_path):
    long = "word. " * 60000
    rows = [(1, None, "user", "a."), (1, None, "user", "a."), (1, 0, "assistant", "b!"), (1, 5, None, "c."), (1, 7, "user", None), (1, 9, "", "d?"),
            (None, 1, "user", "x."), (None, 2, "assistant", "y"), (None, None, None, None), (2, 1, "system", long), (2, 2, "user", long + "x"),
            (2, 3, "assistant", "é? "), (3, 1, "weird", "x."), (3, 1, "assistant", "z."), (3, 1, "user", "z."), (3, 4, "user", "z."), (3, 4, "user", "z.")]
    rows += [(c, t, r, "t.") for c in range(10, 60) for t, r in enumerate(["system", "user", "assistant", "assistant", "user"])]
    want = expected(rows)
    assert run(spark, rows, tmp_path) == want


def test_every_row_dropped_leaves_the_conversation(spark, tmp_path):
    gone = [(c, t) for c in range(400) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:5]
    got = run(spark, [(c, t, "user", "a.") for c, t in gone], tmp_path)
    assert got and all(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for v in got.values())


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path) == {}


@pytest.mark.parametrize("seed", [1, 2])
def test_one_conversation_over_many_tasks(spark, tmp_path, seed):
    """A conversation that holds most rows is cut between tasks; its ties must still be those of one pass."""
    r = random.Random(seed)
    rows = [(7, r.choice([t, t, t - 1, None]), r.choice(["user", "assistant", "system", "user", "x"]), r.choice(["a.", "b", "", f"t{t}.", f"t{t}", "c!"])) for t in range(600)]
    rows += [(c, t, ro, f"{t}.") for c in (6, 8, 9) for t, ro in enumerate(["user", "assistant", "user"])]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, rows, tmp_path, extra=False) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
