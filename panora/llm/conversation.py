"""Conversation structure repair by Four-Russians block tables.

A conversation must read ``(s?(ua)+)?`` in the initials of its roles: an optional system turn,
then user and assistant in turn.  Edits: keep a row (0), give it role user or
assistant (2), delete it (3, required for blank and repeated rows), insert an empty user or
assistant row (2); a truncated row that stays costs 1 more.

A row that must go is always deleted where it stands and changes no state, so only
the other rows count: 8 symbols (initial s, u, a or another; truncated or not).  The cost
to go from each of the four states (start, after s, after u, after a) is a vector;
less its smallest value it is one of a few normalised vectors.  For every
normalised vector and every block of ``BLOCK`` symbols a table holds the vector before the block
and the amount taken off, so that costs run through a conversation from its end, one lookup a
block.  Tracing goes back into the blocks: each block's inner vectors are
expanded from its right border, and then letters are picked from the left, the
ASCII-least one among the cheapest, which a table holds as well.

A conversation may hold any share of the rows: rows are range-partitioned by
(conversation, turn), each partition's part of a conversation is a piece, a piece is a map from
the vector at its right border to the one at its left and a map from entry to exit
state, and two passes over the few pieces of a conversation, backward and forward, join
them.  Repeated rows are counted before any shuffle.  Only the hash of the repaired text, which
is sequential by nature, is taken by one task per conversation, as a stream.

Defined results: a null conv_id is a conversation of its own; null turns come first and
do not count for gaps; null roles and texts are one space; rows of one turn are ordered by
role, then by the MD5 of role and text; repeated rows stand side by side (all but the first are
duplicates); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panora.llm.common import SUB_ROWS, drop_landed, landed, ship
from panora.operators.nullsafe import attach

BLOCK = 4                   # symbols of a block
SYMBOLS = 8                 # initial (s, u, a, other) x truncated
CLASS = {"s": 0, "u": 1, "a": 2}
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
#: state after an inserted (or re-roled) row
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
#: state after a kept row, per initial and state
KEPT = {0: {START: SYSTEM}, 1: {START: USER, SYSTEM: USER, ASSISTANT: USER}, 2: {USER: ASSISTANT}, 3: {}}
LEGAL = ("su", "ua", "au")
PIECE_ROWS = 20_000         # distinct rows of a range partition, about
SPACES = " \t\n\x0b\x0c\r"
OUT_BYTES = 4 << 20


# --------------------------------------------------------------------------- tables
def _settled(costs: list[int]) -> list[int]:
    """Cost vector with insertions before the next row allowed."""
    out = list(costs)
    for _ in range(2):
        out = [min(c, INSERT + out[NEXT[q]]) for q, c in enumerate(out)]
    return out


def _before(costs: tuple[int, ...], symbol: int) -> list[int]:
    """Cost vector before a row, given the one behind it."""
    initial, cut = symbol >> 1, symbol & 1
    out = []
    for q in range(4):
        ways = [costs[q] + DELETE, costs[NEXT[q]] + REROLE + CUT * cut]
        if q in KEPT[initial]:
            ways.append(costs[KEPT[initial][q]] + KEEP + CUT * cut)
        out.append(min(ways))
    return _settled(out)


def _letters(costs: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
    """The ASCII-least cheapest edits at one row (insertions before it, then
    its own) and the state behind it."""
    initial, cut = symbol >> 1, symbol & 1
    here, out = _before(costs, symbol), ""
    while True:
        if here[state] == costs[state] + DELETE:
            return out + "D", state
        if here[state] == INSERT + here[NEXT[state]]:
            out, state = out + "I", NEXT[state]
            continue
        kept = KEPT[initial].get(state)
        if kept is not None and here[state] == costs[kept] + KEEP + CUT * cut:
            return out + "K", kept
        return out + "R", NEXT[state]


class Tables:
    """Normalised vectors, the transitions of one symbol and of a block, and the letters."""

    def __init__(self):
        import numpy as np

        end = _settled([0, 9, 9, 0])          # behind the last row: start and after-a may end
        self.vectors: list[tuple[int, ...]] = [tuple(end)]
        step, taken = [], []
        for v in self.vectors:                # grows while new vectors turn up
            row, off = [], []
            for symbol in range(SYMBOLS):
                costs = _before(v, symbol)
                least = min(costs)
                normal = tuple(c - least for c in costs)
                if normal not in self.vectors:
                    self.vectors.append(normal)
                row.append(self.vectors.index(normal))
                off.append(least)
            step.append(row)
            taken.append(off)
        self.end, self.step = 0, step
        one, one_off = np.array(step), np.array(taken)
        n = len(self.vectors)
        at = np.repeat(np.arange(n)[:, None], SYMBOLS ** BLOCK, axis=1)
        off = np.zeros_like(at)
        codes = np.arange(SYMBOLS ** BLOCK)
        for place in range(BLOCK):            # the block's last symbol comes first
            symbol = codes // SYMBOLS ** place % SYMBOLS
            off += one_off[at, symbol]
            at = one[at, symbol]
        self.one, self.one_off, self.block, self.block_off = one, one_off, at, off
        self.letters = [[[_letters(v, symbol, q) for q in range(4)] for symbol in range(SYMBOLS)]
                        for v in self.vectors]
        self.trailing = ["", "II", "I", ""]   # insertions behind the last row, per state

    def through(self, symbols: list[int]):
        """Per vector at the right border: the one at the left, and the amount taken off."""
        import numpy as np

        at = np.arange(len(self.vectors))
        off = np.zeros(len(self.vectors), np.int64)
        full = len(symbols) // BLOCK * BLOCK
        for symbol in reversed(symbols[full:]):
            off += self.one_off[at, symbol]
            at = self.one[at, symbol]
        for i in range(full - BLOCK, -1, -BLOCK):
            code = reduce(lambda c, s: c * SYMBOLS + s, symbols[i:i + BLOCK], 0)
            off += self.block_off[at, code]
            at = self.block[at, code]
        return at, off

    def behind(self, symbols: list[int], right: int) -> list[int]:
        """The vector behind every row, given the one behind the last: block borders by
        lookup, then each block expanded from its right border."""
        out = [0] * len(symbols)
        full = len(symbols) // BLOCK * BLOCK
        for i in range(len(symbols) - 1, full - 1, -1):
            out[i] = right
            right = self.step[right][symbols[i]]
        for i in range(full - BLOCK, -1, -BLOCK):
            inner = right
            for j in range(i + BLOCK - 1, i - 1, -1):
                out[j] = inner
                inner = self.step[inner][symbols[j]] if j > i else inner
            right = int(self.block[right, reduce(lambda c, s: c * SYMBOLS + s, symbols[i:i + BLOCK], 0)])
        return out


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


# --------------------------------------------------------------------------- rows
def _or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows after the damage that
    the CRC-32 of ``conv_id:turn`` deals out."""
    kind = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn"))) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), _or_space("role").alias("role"),
                                _or_space("text").alias("text"), kind.alias("__kind")).filter(F.col("__kind") != 0)
    k = F.col("__kind")
    return rows.select("conv_id", "turn", F.when(k == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       F.when(k == 1, F.lit("")).when(k == 2, F.translate("text", ".!?", ""))
                       .otherwise(F.col("text")).alias("text"), F.when(k == 3, 2).otherwise(1).alias("copies"))


def _digest() -> Column:
    """Equal for rows of one role and text."""
    return F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))


def _narrow(rows: DataFrame) -> DataFrame:
    """Distinct (conv_id, turn, role, digest) with their number, initial and faults."""
    said = F.rtrim(F.col("text"), F.lit(SPACES))
    last = F.substring(said, -1, 1)
    return (rows.select("conv_id", "turn", "role", _digest().alias("digest"), (said == "").alias("blank"),
                        ((said != "") & ~last.isin(".", "!", "?")).alias("cut"), "copies")
            .groupBy("conv_id", "turn", "role", "digest", "blank", "cut").agg(F.sum("copies").alias("copies")))


def _ordered(rows: DataFrame, *more: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("conv_id", *more, "turn", "role", "digest")]


def _pieces(narrow: DataFrame) -> DataFrame:
    """The narrow rows with ``again`` (role and text seen earlier) and the
    number of their range partition."""
    # only texts of several turns can be repeated beyond their own turn
    firsts = (narrow.filter(~F.col("blank")).groupBy("conv_id", "digest")
              .agg(F.count(F.lit(1)).alias("turns"), F.min("turn").alias("first"),
                   F.max(F.col("turn").isNull()).alias("unset")).filter(F.col("turns") > 1))
    firsts = landed(firsts.select("conv_id", "digest", "first", "unset"), "conversation-repeats")
    seen = F.when(F.col("unset"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first"))
    marked = (attach(narrow, firsts, ["conv_id", "digest"])
              .withColumn("again", ~F.col("blank") & F.coalesce(seen, F.lit(False))).drop("first", "unset"))
    parts = max(2, -(-narrow.count() // PIECE_ROWS))
    spread = marked.repartitionByRange(parts, *_ordered(marked)).withColumn("part", F.spark_partition_id())
    out = landed(spread, "conversation-pieces")
    drop_landed(firsts)
    return out


def _stream(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """``fn`` over the rows of each partition, in their order, as a stream."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    form = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        import pyarrow as pa

        def rows():
            for b in batches:
                for i in range(0, b.num_rows, SUB_ROWS):
                    yield from zip(*(c.to_pylist() for c in b.slice(i, SUB_ROWS).columns))

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), form)], schema=form)

        out, size = [], 0
        for r in fn(rows()):
            out.append(r)
            size += sum(len(x) for x in r if isinstance(x, (str, bytes)))
            if len(out) >= 4096 or size > OUT_BYTES:
                yield batch(out)
                out, size = [], 0
        if out:
            yield batch(out)
    return df.mapInArrow(run, schema)


def _type(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def _grouped(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Neighbouring rows alike in their first ``width`` values."""
    from itertools import groupby

    return groupby(rows, key=lambda r: r[:width])


NARROW = ("part", "conv_id", "turn", "role", "copies", "blank", "again", "cut")


def _symbols(rows: list[tuple]) -> list[int]:
    """The symbols of the rows that need not go."""
    return [CLASS.get(r[3][:1], 3) * 2 + r[7] for r in rows if not (r[5] or r[6])]


# --------------------------------------------------------------------------- passes
def _summaries(pieces: DataFrame) -> DataFrame:
    """One row per piece: its map of cost vectors and what counts of it."""
    def fn(rows):
        t = tables()
        for (part, conv), group in _grouped(rows, 2):
            own = list(group)          # at most a range partition
            at, off = t.through(_symbols(own))
            blank = sum(r[4] for r in own if r[5])
            again = sum(r[4] - (not r[6]) for r in own if not r[5])
            cut = sum(1 for r in own if r[7] and not r[6])
            initials = [r[3][:1] for r in own]
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])) + sum(r[4] - 1 for r in own)
            turns = [r[2] for r in own if r[2] is not None]
            yield (conv, part, at.astype("<i4").tobytes(), off.astype("<i8").tobytes(), blank, again, cut, illegal,
                   initials[0], initials[-1], turns[0] if turns else None, turns[-1] if turns else None,
                   len(set(turns)))

    ordered = pieces.select(*NARROW, "digest").repartition("part", "conv_id").sortWithinPartitions(
        "part", *_ordered(pieces))
    return _stream(ordered.select(*NARROW), fn,
                   f"conv_id {_type(pieces)}, part int, at binary, taken binary, blank long, again long, cut long, "
                   "illegal long, opening string, closing string, low long, high long, turns long")


FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _backward(summaries: DataFrame) -> DataFrame:
    """Per piece the cost vector at its right border; with a conversation's first
    piece (``first``) the numbers of the whole conversation."""
    def fn(rows):
        import numpy as np

        t = tables()
        for (conv,), group in _grouped(rows, 1):
            vector, cost, held = t.end, 0, None
            blank = again = cut = illegal = turns = 0
            low = high = opening = None
            for r in group:            # from the last piece to the first
                if held:
                    yield (*held, False, *[None] * len(FACTS))
                held = (conv, r[1], vector, held is None)
                to = np.frombuffer(r[2], "<i4")[vector]
                cost += int(np.frombuffer(r[3], "<i8")[vector])
                vector = int(to)
                blank, again, cut = blank + r[4], again + r[5], cut + r[6]
                illegal += r[7] + (opening is not None and r[9] + opening not in LEGAL)
                opening = r[8]
                if r[10] is not None:
                    turns += r[12] - (low is not None and r[11] == low)
                    low = r[10]
                    high = r[11] if high is None else high
            gaps = 0 if low is None else high - low + 1 - turns
            cost += t.vectors[vector][START] + DELETE * (blank + again)
            yield (*held, True, gaps, blank, again, cut, illegal, cost)

    ordered = summaries.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(),
                                                                    F.col("part").desc())
    return _stream(ordered, fn, f"conv_id {_type(summaries)}, part int, vector int, last boolean, first boolean, "
                   + ", ".join(f"{c} long" for c in FACTS))


def _traced(pieces: DataFrame, borders: DataFrame) -> DataFrame:
    """Per piece its letters and exit state, for every entry state it may have."""
    def fn(rows):
        t = tables()
        for (part, conv), group in _grouped(rows, 2):
            vector, last, first = next(group)[8:11]
            own = list(group)          # at most a range partition
            symbols = _symbols(own)
            behind = t.behind(symbols, vector)
            letters, exits = [], []
            for state in ((START,) if first else range(4)):
                out, i = [], 0
                for r in own:
                    gone = r[4]
                    if not (r[5] or r[6]):
                        text, state = t.letters[behind[i]][symbols[i]][state]
                        out.append(text)
                        i, gone = i + 1, gone - 1
                    out.append("D" * gone)
                if last:
                    out.append(t.trailing[state])
                letters.append("".join(out))
                exits.append(state)
            # the piece's own first row names its place in the order of all rows
            yield conv, part, letters, exits, own[0][2], own[0][3], own[0][11]

    def filled(df: DataFrame, step: int) -> DataFrame:
        form = {c: pieces.schema[c].dataType for c in (*NARROW, "digest")}
        form.update(vector="int", last="boolean", first="boolean")
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(form[c]).alias(c)
                           for c in (*NARROW, "vector", "last", "first", "digest")], F.lit(step).alias("step"))

    both = filled(borders.drop(*FACTS), 0).unionByName(filled(pieces, 1))
    ordered = both.repartition("part", "conv_id").sortWithinPartitions("part", *_ordered(both, "step"))
    return _stream(ordered.drop("step"), fn, f"conv_id {_type(pieces)}, part int, letters array<string>, "
                   "exits array<int>, turn long, role string, digest string")


def _forward(traced: DataFrame) -> DataFrame:
    """Per piece the letters of the entry state it really has."""
    def fn(rows):
        for (conv,), group in _grouped(rows, 1):
            state = START
            for r in group:            # from the first piece to the last
                way = state if len(r[3]) > 1 else 0
                yield conv, r[1], r[2][way], r[4], r[5], r[6]
                state = r[3][way]

    ordered = traced.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part")
    return _stream(ordered, fn, f"conv_id {_type(traced)}, part int, letters string, turn long, role string, "
                                "digest string")


def _applied(rows: DataFrame, chosen: DataFrame, facts: DataFrame, every: DataFrame) -> DataFrame:
    """The audit and the hash of the repaired text of every conversation."""
    def fn(stream):
        for (conv,), group in _grouped(stream, 1):
            numbers, audit, repaired, said = (0,) * len(FACTS), [], hashlib.sha256(), False
            state, pending, place = START, "", 0

            def say(role: str, text: str) -> None:
                nonlocal said
                repaired.update(b"\n" * said + role.encode() + b":" + text.encode())
                said = True

            def inserted() -> None:
                nonlocal state, place
                while place < len(pending) and pending[place] == "I":
                    say(ROLE[state], "")
                    state = NEXT[state]
                    place += 1

            for r in group:
                kind, role, text, copies, letters = r[1:6]
                if kind == 0:          # the conversation itself, with its numbers
                    numbers = tuple(0 if x is None else x for x in r[6:])
                elif kind == 1:        # the letters of a piece
                    inserted()
                    audit.append(letters)
                    pending, place = letters, 0
                else:
                    for _ in range(copies):
                        inserted()
                        edit = pending[place]
                        place += 1
                        if edit == "K":
                            say(role, text)
                            state = KEPT[CLASS[role[:1]]][state]
                        elif edit == "R":
                            say(ROLE[state], text)
                            state = NEXT[state]
            inserted()
            yield (conv, *numbers, "".join(audit), repaired.hexdigest())

    def filled(df: DataFrame, kind: int, **given: Column) -> DataFrame:
        form = {"turn": "long", "role": "string", "digest": "string", "text": "string", "copies": "int",
                "letters": "string", **dict.fromkeys(FACTS, "long")}
        return df.select("conv_id", F.lit(min(kind, 1)).alias("step"), F.lit(kind).alias("kind"),
                         *[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in form.items()])

    known = attach(every, facts, ["conv_id"])
    stream = (filled(known, 0, **{c: F.col(c) for c in FACTS})
              .unionByName(filled(chosen, 1, **{c: F.col(c) for c in ("turn", "role", "digest", "letters")}))
              .unionByName(filled(rows.withColumn("digest", _digest()), 2,
                                  **{c: F.col(c) for c in ("turn", "role", "digest", "text", "copies")})))
    ordered = stream.repartition("conv_id").sortWithinPartitions(
        *[F.col(c).asc_nulls_first() for c in ("conv_id", "step", "turn", "role", "digest", "kind")])
    return _stream(ordered.select("conv_id", "kind", "role", "text", "copies", "letters", *FACTS), fn,
                   f"conv_id {_type(every)}, " + ", ".join(f"{c} long" for c in FACTS)
                   + ", audit string, repaired_sha256 string")


def repaired(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, copies) and of ``every`` (conv_id):
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    every = (rows if every is None else every).select("conv_id").distinct()
    narrow = landed(_narrow(rows), "conversation-rows")
    pieces = _pieces(narrow)
    drop_landed(narrow)
    borders = landed(_backward(_summaries(pieces)), "conversation-borders")
    chosen = _forward(_traced(pieces, borders))
    facts = borders.filter("first").select("conv_id", *FACTS)
    out = _applied(rows, chosen, facts, every)
    return out
