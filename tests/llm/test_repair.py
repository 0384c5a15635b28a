"""Conversation repair against a search over all edits, with large blocks and with many levels of small ones."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import types as T

from seqtables.llm import repair

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("edits", T.StringType()), T.StructField("copies", T.IntegerType()),
    T.StructField("node", T.DoubleType()), T.StructField("digest", T.StringType())])
ROLES = ["system", "user", "assistant", "tool", "", None, "user", "assistant", "User", "sage"]
TEXTS = ["Yes.", "no", " \t", "", None, "What?  ", "a.b", "é", "Yes.", "x" * 5000 + "!"]


def conversations():
    rng = random.Random(11)
    rows = []
    for conv in range(60):
        turn = rng.choice([0, 0, 1, -3])
        for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13])):
            rows.append((conv, turn, rng.choice(ROLES), rng.choice(TEXTS) if rng.random() < 0.5 else f"text {rng.randint(0, 9)}."))
            turn += rng.choice([1, 1, 1, 0, 3])
    for turn in range(45):
        rows.append((77, turn, rng.choice(ROLES[:4]), rng.choice(TEXTS) if rng.random() < 0.3 else f"line {turn}."))
    rows += [(78, None, "user", "hello."), (78, None, None, "hello."), (78, 4, "assistant", "sure"), (None, 1, "user", "a."), (None, None, "x", None)]
    rows += [(79, 1, "user", "same.")] * 40 + [(80, t, "assistant", "same.") for t in range(30)]
    return [(*r, "D", 7, 0.5, "d") for r in rows]


def damage(rows):
    found = []
    for conv, turn, role, text, *_ in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        mark = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if mark == 1:
            text = ""
        if mark == 2:
            text = re.sub("[.!?]", "", text)
        if mark == 4:
            role = "user"
        found += [] if mark == 0 else [(conv, turn, role, text)] * (2 if mark == 3 else 1)
    return found


def faults_of(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        found.append(kind)
    return found


def cheapest(rows, kinds):
    """Least (cost, edits) by dynamic programming over all edits, and the repaired rows."""
    grammar = {"": "su", "s": "u", "u": "a", "a": "u"}  # what may follow
    best = {"": (0, "", ())}

    def insert(states):
        for _ in range(3):
            for state, (cost, edits, out) in list(states.items()):
                for role in ("user", "assistant"):
                    if role[0] in grammar[state] and role[0] != "s":
                        new = (cost + 2, edits + "I", (*out, (role, "")))
                        if role[0] not in states or new[:2] < states[role[0]][:2]:
                            states[role[0]] = new
        return states

    for (_, _, role, text), kind in zip(rows, kinds):
        states = {}
        for state, (cost, edits, out) in insert(best).items():
            options = [(state, 3, "D", out)]
            if kind not in ("blank", "duplicate"):
                extra = int(kind == "truncated")
                if role[:1] and role[0] in grammar[state]:
                    options.append((role[0], extra, "K", (*out, (role, text))))
                for new in ("user", "assistant"):
                    if new[0] in grammar[state]:
                        options.append((new[0], 2 + extra, "R", (*out, (new, text))))
            for after, more, edit, result in options:
                new = (cost + more, edits + edit, result)
                if after not in states or new[:2] < states[after][:2]:
                    states[after] = new
        best = states
    ends = insert(best)
    return min((ends[s] for s in ("", "a") if s in ends), key=lambda x: x[:2])


def expected(rows):
    found = {}
    there = damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in there if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        kinds = faults_of(mine)
        turns = {r[1] for r in mine if r[1] is not None}
        cost, edits, out = cheapest(mine, kinds)
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
            sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])), cost, edits,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())
    return found


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(conversations(), SCHEMA).repartition(5)


@pytest.mark.parametrize("block_bits, fan", [(repair.BLOCK_BITS, repair.FAN), (1, 2), (2, 4)])
def test_audit_is_the_cheapest_repair(table, block_bits, fan):
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.audit(repair.damaged(table), block_bits, fan).collect()}
    want = expected(conversations())
    assert got == want


def test_repaired_rows(table):
    rows = repair.repaired(repair.damaged(table), 2, 4).collect()
    want = expected(conversations())
    for conv in want:
        mine = sorted((r for r in rows if r["conv_id"] == conv), key=lambda r: r["position"])
        assert [r["position"] for r in mine] == list(range(len(mine)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in mine))
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in mine).encode()).hexdigest() == want[conv][-1]
        assert [r["edit"] for r in mine] == [e for e in want[conv][-2] if e != "D"]


def test_sound_conversations_stay(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    [row] = repair.audit(repair.plain(table)).collect()
    assert (row["cost"], row["audit"], row["illegal"]) == (0, "KKK", 0)
    assert [tuple(r)[-2:] for r in sorted(repair.repaired(repair.plain(table)).collect(), key=lambda r: r["position"])] == [r[2:] for r in rows]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.audit(repair.damaged(empty)).count() == 0
    assert repair.repaired(repair.damaged(empty)).count() == 0


def test_prices_are_least_costs():
    """Every code sequence of up to three rows: the auction's prices against relaxation over all arcs."""
    for size in (0, 1, 2, 3):
        for codes in product("abcdefghijkl"[::2] + "dj", repeat=size):
            layers = repair.row_layers("".join(codes))
            for after in [list(repair.ENDS)] + repair._goals():
                price = [repair.NEVER] * (4 * size) + list(after)
                for _ in range(4 * size + 4):
                    for v in range(4 * size):
                        price[v] = min(price[v], min(c + price[v + step] for _, step, c in layers[v >> 2][v & 3]))
                assert repair.converged(layers, after) == [min(p, repair.NEVER) for p in price]
