"""Conversation repair against a plain dynamic programme over whole conversations."""

import binascii
import hashlib
import itertools
import random
from collections import defaultdict
from functools import lru_cache

import pytest

from panora.llm import conversation
from panora.llm.queries import op12_conversation_repair
from tests.llm.helpers import folder

SCHEMA = "conv_id long, turn long, role string, text string, letters string, kind int"
SPACES = " \t\n\x0b\x0c\r"


def damage(rows):
    """(conv, turn, role, text) rows after the damage."""
    out = []
    for conv, turn, role, text in rows:
        conv_, turn_ = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = binascii.crc32(f"{conv_}:{turn_}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain(rows):
    """The contract's columns by a recursion on (row, initials so far)."""
    digest = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r[2], r[3])))
    faults, seen = [], set()
    for _, _, role, text in rows:
        said = text.rstrip(SPACES)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen
                      else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    # states: 0 start, 1 system read, 2 user read, 3 assistant read
    step = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("2", "a"): "3", ("3", "u"): "2"}

    @lru_cache(None)
    def best(i, state, room=2):
        """(cost, letters) of the cheapest way on, ASCII-least; at most ``room`` insertions before row i."""
        ways = [(0, "")] if i == len(rows) and state in "03" else []
        moves = [(to, "I", 2, i) for r in "ua" if room and (to := step.get((state, r)))]
        if i < len(rows):
            cut = faults[i] == "truncated"
            moves.append((state, "D", 3, i + 1))
            if faults[i] not in ("blank", "duplicate"):
                moves += [(to, "K", cut, i + 1) for to in [step.get((state, rows[i][2][:1]))] if to]
                moves += [(to, "R", 2 + cut, i + 1) for r in "ua" if (to := step.get((state, r)))]
        for to, letter, price, at in moves:
            cost, letters = best(at, to, room - 1 if letter == "I" else 2)
            ways.append((cost + price, letter + letters))
        return min(ways, default=(10 ** 9, ""))

    cost, audit = best(0, "0")
    out, state, i = [], "0", 0
    for letter in audit:
        role = "a" if state == "2" else "u"
        if letter == "I":
            out.append(({"u": "user", "a": "assistant"}[role], ""))
        elif letter == "R":
            out.append(({"u": "user", "a": "assistant"}[role], rows[i][3]))
        elif letter == "K":
            out.append(rows[i][2:4])
            role = rows[i][2][:1]
        i += letter != "I"
        state = state if letter == "D" else step[(state, role)]
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()}


def expected(rows):
    convs = defaultdict(list)
    for r in rows:
        convs[r[0]]
    for r in damage(rows):
        convs[r[0]].append(r)
    return {c: plain(rs) for c, rs in convs.items()}


def got(df):
    rows = [r.asDict() for r in df.collect()]
    out = {r.pop("conv_id"): r for r in rows}
    assert len(out) == len(rows)
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def some(rng, conv, n):
    roles = ["user", "assistant", "system", "tool", "", "unknown", None, "a"]
    texts = ["Yes.", "No!", "cut", "", " \t", "long text here? ", "x", None, "é.", "Yes.\n"]
    return [(conv, rng.choice([None, rng.randint(0, 2 * n), i, i]), rng.choices(roles, [8, 8, 2, 1, 1, 1, 1, 1])[0],
             rng.choice(texts) if rng.random() < 0.7 else f"say {rng.random()}.") for i in range(n)]


def test_short_conversations(spark):
    rng = random.Random(3)
    rows = [r for c in range(300) for r in some(rng, c, rng.randint(1, 9))]
    rows += some(rng, None, 6) + rows[:7] * 3                       # a null id, repeated rows
    assert got(op12(spark, rows)) == expected(rows)


def op12(spark, rows):
    df = table(spark, rows)
    return conversation.repaired(conversation.damaged(df), df)


def test_conversations_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation, "PIECE_ROWS", 15)
    rng = random.Random(4)
    rows = some(rng, 1, 150) + [r for c in (2, 3, 4) for r in some(rng, c, 20)]
    rows += [(5, i, "user", "same text.") for i in range(60)]       # one text in many turns
    rows += [(6, 1, "assistant", "same row.")] * 50                 # one row many times
    rows += [(7, None, "system", "no turn.")] * 3
    assert got(op12(spark, rows)) == expected(rows)


@pytest.mark.parametrize("initials", ["".join(p) for n in (1, 2, 3) for p in itertools.product("suax", repeat=n)][::5])
def test_tables_agree_with_the_recursion(initials):
    names = {"s": "system", "u": "user", "a": "assistant", "x": "x"}
    rows = [(0, i, names[c], f"text {i}" + "." * (i % 2)) for i, c in enumerate(initials * 3)]
    want = plain(rows)
    t = conversation.tables()
    own = [(0, 0, r[1], r[2], 1, False, False, r[3][-1] != ".") for r in rows]
    symbols = conversation._symbols(own)
    at, off = t.through(symbols)
    assert off[t.end] + t.vectors[at[t.end]][0] == want["cost"]


def test_few_vectors():
    t = conversation.tables()
    assert len(t.vectors) < 40 and t.block.shape == (len(t.vectors), 8 ** conversation.BLOCK)


def test_query_and_odd_tables(spark, tmp_path):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."), (2, 0, "system", "Be kind."), (None, None, None, None)]
    sf = folder(tmp_path, conversations=table(spark, rows))
    out = op12_conversation_repair(spark, sf)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                           "repaired_sha256"]
    assert got(out) == expected(rows)
    assert op12(spark, []).count() == 0


def test_a_conversation_whose_rows_all_went(spark):
    gone = [(c, 0, "user", "Hi.") for c in range(400) if binascii.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone
    empty = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
             "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    assert got(op12(spark, gone)) == {r[0]: empty for r in gone}


def test_very_long_texts(spark):
    rows = [(1, 0, "user", "word " * 200_000 + "."), (1, 1, "assistant", " " * 300_000 + "x")]
    assert got(op12(spark, rows)) == expected(rows)
