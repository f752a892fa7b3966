"""Cheapest repair of damaged conversations, by tables over blocks of symbols.

A repaired conversation has roles whose initials read ``(s?(ua)+)?``. A row may be kept (K, free),
get the role user or assistant (R, 3) or be deleted (D, 4; blank and repeated rows have to be),
and an empty message may be inserted anywhere (I, 3). A truncated row that stays costs 3 more.
Of the cheapest edits those whose letters come first in ASCII are taken.

A row is a symbol: its role and fault. What the rest of a conversation costs is a vector over the
four states of the pattern. Less its minimum, it is one of a few vectors, so the method of the
Four Russians applies: for every block of ``LENGTH`` symbols and every vector a table holds the
vector before the block and what the minimum grows by. Blocks are looked up from the last to the
first; then they are expanded in the other direction, from the first letter on, which settles
ties, since the first letter that differs decides.

A conversation of any length works in pieces. Rows are sorted by range, a conversation that lies
inside one task is repaired there, and what spans tasks, or has more than ``CHUNK`` rows, becomes
chunks, each with the transition of all vectors. A pass from the last chunk to the first fixes the
vectors and a pass back the states; then all chunks are expanded in parallel. Only the digest of a
conversation's text is made in one task, from a stream of chunks, as a digest has to be.

Null roles and texts count as one space, null ids and turns as one space in the checksum. A null
conversation id is a conversation. Rows of one turn are ordered by role and then by a digest of
role and text, null turns come first. Equal rows are spread by their row number, and all but the
first are duplicates. Other columns, whatever their names, go. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packwright.llm.components import Scratch, stored
from packwright.llm.frames import task_map

#: Symbols of a block, rows and bytes of text of a chunk.
LENGTH, CHUNK, CHUNK_BYTES = 4, 4096, 4 << 20

# Edit costs, and the pattern ``(s?(ua)+)?`` as states (begun, after s, u, a).
RETITLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, STATES = 0, 4
AFTER = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")
NAMES = {"u": b"user", "a": b"assistant"}

#: Symbols: two for each of s, u, a and other roles, sound or truncated; one that has to go; one for no row.
ROLES = "sua?"
GONE, PAD = 8, 9
SYMBOLS = 10
_FAR = 1 << 20
_SPACE = b" \t\n\x0b\x0c\r"


def symbol(role: bytes, fault: str | None) -> int:
    """Symbol of a row."""
    if fault in ("blank", "duplicate"):
        return GONE
    initial = initial_of(role)
    place = ROLES.index(initial) if initial and initial in "sua" else 3
    return 2 * place + (fault == "truncated")


def initial_of(role: bytes) -> str:
    return role[:4].decode("utf-8", "replace")[:1]


def fault_of(text: bytes, repeated: bool) -> str | None:
    """First fault of a row."""
    seen = text.strip(_SPACE)
    if not seen:
        return "blank"
    if repeated:
        return "duplicate"
    return None if seen[-1:] in b".!?" else "truncated"


def _closed(costs: list[int]) -> tuple[int, ...]:
    """Costs when messages may be inserted first."""
    costs = list(costs)
    for _ in range(STATES):
        for state in range(STATES):
            for role in "ua":
                if role in AFTER[state]:
                    costs[state] = min(costs[state], INSERT + costs[AFTER[state][role]])
    return tuple(costs)


def _edits(sign: int, state: int, later: tuple[int, ...]) -> Iterator[tuple[str, str | None, int, int]]:
    """Edits of a row in a state: ``(letter, new role, state after, cost to the end)``, in ASCII order."""
    yield "D", None, state, DELETE + later[state]
    if sign != GONE:
        more = TRUNCATED * (sign % 2)
        kept = ROLES[sign // 2]
        if kept in AFTER[state]:
            yield "K", None, AFTER[state][kept], more + later[AFTER[state][kept]]
        for role in "ua":
            if role in AFTER[state]:
                yield "R", role, AFTER[state][role], RETITLE + more + later[AFTER[state][role]]


def _before(sign: int, later: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row, from those after it."""
    if sign == PAD:
        return later
    return _closed([min(cost for *_, cost in _edits(sign, state, later)) for state in range(STATES)])


def _step(sign: int, state: int, later: tuple[int, ...]):
    """Letters of one row, roles inserted before it, what becomes of it, and the state after."""
    if sign == PAD:
        return "", (), None, state
    now, letters, added = _before(sign, later), "", []
    while True:
        # D comes first, then I, then K and R: the first edit on a cheapest path is the one.
        edits = [e for e in _edits(sign, state, later) if e[3] == now[state]]
        role = next((r for r in "ua" if r in AFTER[state]), None)
        if edits and edits[0][0] == "D" or role is None or INSERT + now[AFTER[state][role]] != now[state]:
            letter, new, after, _ = edits[0]
            return letters + letter, tuple(added), {"D": None, "K": b""}.get(letter, NAMES.get(new)), after
        letters += "I"
        added.append(NAMES[role])
        state = AFTER[state][role]


def trailing(state: int) -> tuple[str, list[bytes]]:
    """Letters and roles that end a conversation in a state."""
    added = []
    while state not in ENDS:
        role = next(r for r in "ua" if r in AFTER[state])
        added.append(NAMES[role])
        state = AFTER[state][role]
    return "I" * len(added), added


class Tables:
    """Transitions of normalised vectors by symbol and by block.

    ``following[v, b]`` is the vector before block ``b`` when ``v`` holds after it, ``growth`` what
    the minimum grows by, and ``leaving[v, b, q]`` the state after the block that is entered in
    state ``q``. A block's number has its first symbol in the lowest digit.
    """

    def __init__(self) -> None:
        last = _closed([0 if s in ENDS else _FAR for s in range(STATES)])
        self.vectors, places = [last], {last: 0}
        following, growth = [], []
        for vector in self.vectors:
            row, more = [], []
            for sign in range(SYMBOLS):
                costs = _before(sign, vector)
                least = min(costs)
                found = tuple(c - least for c in costs)
                if found not in places:
                    places[found] = len(self.vectors)
                    self.vectors.append(found)
                row.append(places[found])
                more.append(least)
            following.append(row)
            growth.append(more)
        self.by_symbol = following
        self.steps = [[[_step(s, q, v) for q in range(STATES)] for s in range(SYMBOLS)] for v in self.vectors]
        one, more = np.array(following, np.int16), np.array(growth, np.int32)
        leave = np.array([[[self.steps[v][s][q][3] for q in range(STATES)] for s in range(SYMBOLS)] for v in range(len(self.vectors))], np.int8)
        self.following, self.growth, self.leaving = one, more, leave
        for _ in range(LENGTH - 1):
            # The new first symbol is applied last, and its steps come first.
            self._prepend(one, more, leave)
        self._expanded: dict = {}

    def _prepend(self, one: np.ndarray, more: np.ndarray, leave: np.ndarray) -> None:
        count = len(self.vectors)
        before = one[self.following]
        growth = self.growth[:, :, None] + more[self.following]
        entered = leave[self.following]
        after = np.take_along_axis(self.leaving[:, :, None, :], entered.astype(np.int64), axis=3)
        self.following = before.reshape(count, -1)
        self.growth = growth.reshape(count, -1)
        self.leaving = after.reshape(count, -1, STATES)

    def expand(self, later: int, block: int, state: int) -> tuple[list, int]:
        """Steps of a block's rows and the state after, from the vector after it."""
        key = (later, block, state)
        if key not in self._expanded:
            signs = [block // SYMBOLS**i % SYMBOLS for i in range(LENGTH)]
            vectors = [later]
            for sign in reversed(signs):
                vectors.append(self.by_symbol[vectors[-1]][sign])
            found, now = [], state
            for i, sign in enumerate(signs):
                step = self.steps[vectors[LENGTH - 1 - i]][sign][now]
                now = step[3]
                if sign != PAD:
                    found.append(step[:3])
            self._expanded[key] = found, now
        return self._expanded[key]


@cache
def tables() -> Tables:
    return Tables()


def blocks_of(signs: list[int]) -> list[int]:
    """Numbers of the blocks that the symbols make up; the last is padded."""
    signs = signs + [PAD] * (-len(signs) % LENGTH)
    powers = [SYMBOLS**i for i in range(LENGTH)]
    return [sum(s * p for s, p in zip(signs[i : i + LENGTH], powers, strict=True)) for i in range(0, len(signs), LENGTH)]


def looked_up(blocks: list[int], last: int = 0) -> tuple[list[int], int]:
    """The vector after each block, then that before the first; and the growth of the minimum."""
    t, vectors, cost = tables(), [last], 0
    for block in reversed(blocks):
        now = vectors[-1]
        cost += int(t.growth[now, block])
        vectors.append(int(t.following[now, block]))
    return vectors[::-1], cost


def expanded(blocks: list[int], rows: list[tuple[bytes, bytes]], last: int, state: int) -> tuple[str, list[bytes], int]:
    """Letters, repaired rows and the state after the blocks."""
    t = tables()
    vectors, _ = looked_up(blocks, last)
    letters, kept, row = [], [], 0
    for place, block in enumerate(blocks):
        steps, state = t.expand(vectors[place + 1], block, state)
        for edits, added, change in steps:
            letters.append(edits)
            kept += [role + b":" for role in added]
            if change is not None:
                role, text = rows[row]
                kept.append((change or role) + b":" + text)
            row += 1
    return "".join(letters), kept, state


def transition(blocks: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every vector after the blocks: the one before, the growth, and the state after by state entered."""
    t = tables()
    count = len(t.vectors)
    vectors, growth = [np.arange(count)], np.zeros(count, np.int64)
    for block in reversed(blocks):
        growth += t.growth[vectors[-1], block]
        vectors.append(t.following[vectors[-1], block].astype(np.int64))
    states = np.tile(np.arange(STATES), (count, 1))
    for place, block in enumerate(blocks):
        after = vectors[len(blocks) - 1 - place]
        states = t.leaving[after[:, None], block, states].astype(np.int64)
    return vectors[-1], growth, states


class Piece:
    """Rows of one conversation that are sorted one after the other."""

    def __init__(self) -> None:
        self.rows, self.signs, self.size = [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.low, self.high = 0, None, None
        self.first = self.last = None

    def add(self, turn: int | None, role: bytes, text: bytes, repeated: bool) -> None:
        fault = fault_of(text, repeated)
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        self.rows.append((role, text))
        self.signs.append(symbol(role, fault))
        self.size += len(role) + len(text)
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        initial = initial_of(role)
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.last = initial

    def facts(self) -> dict:
        return {k: getattr(self, k) for k in FACTS}


FACTS = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last")
_FACT_TYPES = [(n, pa.int64()) for n in FACTS[:7]] + [(n, pa.string()) for n in FACTS[7:]]
_COUNTS = [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
_DONE = [*_COUNTS, ("audit", pa.string()), ("repaired_sha256", pa.string())]
_CHUNK = [
    ("task", pa.int64()), ("seq", pa.int64()), ("blocks", pa.binary()), ("roles", pa.list_(pa.binary())), ("texts", pa.list_(pa.binary())),
    ("following", pa.binary()), ("growth", pa.binary()), ("leaving", pa.binary()),
]


def _gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


def _whole(piece: Piece) -> dict:
    blocks = blocks_of(piece.signs)
    vectors, cost = looked_up(blocks)
    letters, kept, state = expanded(blocks, piece.rows, 0, START)
    more, added = trailing(state)
    text = b"\n".join(kept + [role + b":" for role in added])
    return {
        "gaps": _gaps(piece.low, piece.high, piece.turns),
        "blank": piece.blank,
        "duplicate": piece.duplicate,
        "truncated": piece.truncated,
        "illegal": piece.illegal,
        "cost": cost + tables().vectors[vectors[0]][START],
        "audit": letters + more,
        "repaired_sha256": hashlib.sha256(text).hexdigest(),
    }


def _chunk(piece: Piece, task: int, seq: int) -> dict:
    blocks = blocks_of(piece.signs)
    following, growth, leaving = transition(blocks)
    return piece.facts() | {
        "task": task,
        "seq": seq,
        "blocks": np.array(blocks, np.int16).tobytes(),
        "roles": [r for r, _ in piece.rows],
        "texts": [t for _, t in piece.rows],
        "following": following.astype(np.int16).tobytes(),
        "growth": growth.astype(np.int64).tobytes(),
        "leaving": leaving.astype(np.int8).tobytes(),
    }


class _Out:
    """Rows that leave in record batches of bounded size."""

    def __init__(self, fields: list, rows: int = 2048, size: int = 8 << 20) -> None:
        self.fields, self.rows, self.size = fields, rows, size
        self.held, self.bytes = [], 0

    def put(self, row: dict, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.held.append(row)
        self.bytes += size
        if len(self.held) >= self.rows or self.bytes >= self.size:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in self.held], t) for n, t in self.fields], [n for n, _ in self.fields])
        self.held, self.bytes = [], 0


def _cells(batches) -> Iterator[dict]:
    """Rows of record batches, few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            yield from batch.slice(start, 256).to_pylist()


def _spark(fields: list) -> str:
    names = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary", pa.list_(pa.binary()): "array<binary>"}
    return ", ".join(f"{n} {names[t]}" for n, t in fields)


def _sorted_pieces(batches, kind: pa.DataType, chunk: int) -> Iterator[pa.RecordBatch]:
    """Whole conversations repaired, others in chunks; rows come sorted by conversation.

    The first and the last conversation of a task may go on in others.
    """
    out = _Out([("conv", kind), *_DONE, *_CHUNK, *[f for f in _FACT_TYPES if f[0] not in dict(_DONE)]])
    task, seq = TaskContext.get().partitionId(), 0
    now, piece, inner = None, None, False
    for row in _cells(batches):
        key = (row["conv"],)
        if key != now:
            if piece is not None:
                found = {"conv": now[0]} | (_whole(piece) if inner else _chunk(piece, task, seq))
                yield from out.put(found, piece.size)
                seq += 1
            inner = piece is not None
            now, piece = key, Piece()
        elif len(piece.rows) >= chunk or piece.size >= CHUNK_BYTES:
            yield from out.put({"conv": now[0]} | _chunk(piece, task, seq), piece.size)
            seq, piece, inner = seq + 1, Piece(), False
        piece.add(row["turn"], row["role"], row["text"], row["repeated"])
    if piece is not None:
        yield from out.put({"conv": now[0]} | _chunk(piece, task, seq), piece.size)
    yield from out.flush()


def _from_last(batches, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The vector after each chunk and the states it turns states into; chunks come from the last to the first."""
    out = _Out([("conv", kind), ("task", pa.int64()), ("seq", pa.int64()), ("vector", pa.int64()), ("onward", pa.binary()), ("cost", pa.int64()), ("ends", pa.int64())])
    now, vector = None, 0
    start = np.array([v[START] for v in tables().vectors])
    for row in _cells(batches):
        ends = int((row["conv"],) != now)
        if ends:
            # Costs count from nothing at the end of a conversation.
            now, vector, before = (row["conv"],), 0, 0
        growth = int(np.frombuffer(row["growth"], np.int64)[vector])
        onward = row["leaving"][vector * STATES : (vector + 1) * STATES]
        after, vector = vector, int(np.frombuffer(row["following"], np.int16)[vector])
        # What the chunk adds to the cost of the conversation if it is the first one.
        cost = growth + int(start[vector]) - before
        before = int(start[vector])
        yield from out.put({"conv": now[0], "task": row["task"], "seq": row["seq"], "vector": after, "onward": onward, "cost": cost, "ends": ends})
    yield from out.flush()


def _from_first(batches) -> Iterator[pa.RecordBatch]:
    """The state in which each chunk is entered; chunks come from the first to the last."""
    out = _Out([(n, pa.int64()) for n in ("task", "seq", "vector", "state", "cost", "ends")])
    now, state = None, START
    for row in _cells(batches):
        if (row["conv"],) != now:
            now, state = (row["conv"],), START
        yield from out.put({**row, "state": state})
        state = row["onward"][state]
    yield from out.flush()


def _expanded_chunks(batches, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    out = _Out([("conv", kind), *_PIECE], rows=64)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            blocks = np.frombuffer(row["blocks"], np.int16).tolist()
            letters, kept, state = expanded(blocks, list(zip(row["roles"], row["texts"], strict=True)), row["vector"], row["state"])
            more, added = trailing(state) if row["ends"] else ("", [])
            kept += [role + b":" for role in added]
            text = b"\n".join(kept) if kept else None
            yield from out.put({**row, "audit": letters + more, "text": text}, len(text or b""))
    yield from out.flush()


_PIECE = [("task", pa.int64()), ("seq", pa.int64()), ("cost", pa.int64()), *_FACT_TYPES, ("audit", pa.string()), ("text", pa.binary())]


def _joined_pieces(batches, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its expanded chunks, which come in order and are not kept."""
    out, now = _Out([("conv", kind), *_DONE]), None
    rows = chain((row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist()), [None])
    for row in rows:
        if now is not None and (row is None or row["conv"] != found["conv"]):
            found |= {"gaps": _gaps(low, high, turns), "audit": "".join(letters), "repaired_sha256": digest.hexdigest()}
            yield from out.put(found)
            now = None
        if row is None:
            break
        if now is None:
            found = {"conv": row["conv"]} | dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
            now, letters, digest, begun = True, [], hashlib.sha256(), False
            low = high = last = None
            turns = 0
        for name in ("blank", "duplicate", "truncated", "illegal", "cost"):
            found[name] += row[name]
        if last is not None:
            found["illegal"] += last + row["first"] not in LEGAL
        last = row["last"]
        if row["low"] is not None:
            turns += row["turns"] - (row["low"] == high)
            low, high = row["low"] if low is None else low, row["high"]
        letters.append(row["audit"])
        if row["text"] is not None:
            digest.update((b"\n" if begun else b"") + row["text"])
            begun = True
    yield from out.flush()


def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv, turn, role, text, copies)`` of all rows after damage; a dropped row has no copies.

    The checksum of conversation and turn modulo 20 decides: 0 drops a row, 1 empties its text,
    2 removes its full stops, exclamation and question marks, 3 doubles it, 4 makes it the user's.
    """
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`")
    key = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    lot = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    text = F.when(lot == 1, "").when(lot == 2, F.translate(text, ".!?", "")).otherwise(text)
    return df.select(
        conv.alias("conv"),
        turn.cast("bigint").alias("turn"),
        F.when(lot == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.when(lot == 0, 0).when(lot == 3, 2).otherwise(1).alias("copies"),
    )


def untouched(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv, turn, role, text, copies)`` of rows that are repaired as they are."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    return df.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), F.lit(1).alias("copies")
    )


def repair(rows: DataFrame, conv_col: str = "conv_id", chunk: int = CHUNK) -> DataFrame:
    """``(conv_col, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``.

    ``rows`` come from :func:`damaged` or :func:`untouched`. Every conversation has its row; one
    without rows after damage has zeros, no edits and the digest of nothing. ``chunk`` rows of one
    conversation are worked on at a time.
    """
    kind, scratch = dict(rows.dtypes)["conv"], Scratch(rows.sparkSession)
    same = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    numbered = rows.select("*", same.alias("same"), F.monotonically_increasing_id().alias("row"))
    present = numbered.where("copies > 0")

    # Rows whose role and text come more than once in a conversation: all but the first repeat.
    first = F.min(F.struct("turn", "row"))["row"].alias("original")
    several = present.groupBy("conv", "same").agg(first, F.count(F.lit(1)).alias("times")).where("times > 1")
    several = several.select(F.col("conv").alias("c"), F.col("same").alias("s"), "original")
    marked = present.join(several, F.col("conv").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")), "left")
    copy = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    marked = marked.select("conv", "turn", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), "same", "row", "original", copy)
    repeated = (F.col("copy") > 0) | F.coalesce(F.col("row") != F.col("original"), F.lit(False))
    order = ["conv", "turn", "role", "same", "row", "copy"]
    ordered = marked.withColumn("repeated", repeated).repartitionByRange(*order).sortWithinPartitions(*order)
    field = pa.int64() if kind == "bigint" else _arrow(rows)
    others = [f for f in _FACT_TYPES if f[0] not in dict(_DONE)]
    pieces = task_map(
        ordered.select("conv", "turn", "role", "text", "repeated"), lambda b: _sorted_pieces(b, field, chunk), f"conv {kind}, {_spark([*_DONE, *_CHUNK, *others])}"
    )
    pieces = scratch.stored(pieces)
    whole = ["conv", *[n for n, _ in _DONE]]
    done = pieces.where("task is null").select(*whole)

    chunks = pieces.where("task is not null").drop("gaps", "cost", "audit", "repaired_sha256")
    back = chunks.select("conv", "task", "seq", "following", "growth", "leaving").repartition("conv")
    back = back.sortWithinPartitions(F.col("conv"), F.col("task").desc(), F.col("seq").desc())
    back = task_map(back, lambda b: _from_last(b, field), f"conv {kind}, task bigint, seq bigint, vector bigint, onward binary, cost bigint, ends bigint")
    entered = task_map(
        back.repartition("conv").sortWithinPartitions("conv", "task", "seq"), _from_first, "task bigint, seq bigint, vector bigint, state bigint, cost bigint, ends bigint"
    )
    parts = task_map(chunks.join(entered, ["task", "seq"]), lambda b: _expanded_chunks(b, field), f"conv {kind}, {_spark(_PIECE)}")
    joined = parts.repartition("conv").sortWithinPartitions("conv", "task", "seq")
    joined = task_map(joined, lambda b: _joined_pieces(b, field), f"conv {kind}, {_spark(_DONE)}")

    zeros = [F.lit(0).cast("bigint").alias(n) for n, _ in _COUNTS]
    lost = rows.groupBy("conv").agg(F.sum("copies").alias("left")).where("left = 0")
    lost = lost.select("conv", *zeros, F.lit("").alias("audit"), F.sha2(F.lit("").cast("binary"), 256).alias("repaired_sha256"))
    result = stored(done.unionByName(joined.select(*whole)).unionByName(lost).withColumnRenamed("conv", conv_col))
    scratch.clear()
    return result


def _arrow(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["conv"].dataType)


def sql(crc32: str) -> str:
    """DuckDB SQL for :func:`repair` of damaged ``conversations``; ``crc32`` is SQL for the checksum of ``key``."""
    state = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR)"

    def moved(source: str, cost: str, letter: str, row: str) -> str:
        text = f"{source}.r || {row} || chr(10)" if row else f"{source}.r"
        return f"{{'c': {source}.c + {cost}, 'a': {source}.a || '{letter}', 'r': {text}}}"

    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def when(test: str, option: str) -> str:
        return f"CASE WHEN {test} THEN {option} ELSE {never} END"

    never = f"CAST({{'c': 1000000000, 'a': '~', 'r': ''}} AS {state})"
    stay = "NOT gone"
    more = "CASE WHEN cut THEN 3 ELSE 0 END"

    def arrive(role: str, name: str, sources: list[str], at: str) -> str:
        options = [moved(at, "4", "D", "")] if at else []
        for s in sources:
            options.append(when(f"{stay} AND first = '{role}'", moved(s, more, "K", "role || ':' || text")))
            if name:
                options.append(when(stay, moved(s, f"3 + {more}", "R", f"'{name}:' || text")))
        return least(*options)

    def inserted(prefix: str) -> str:
        u = least(f"{prefix}2", *[moved(f"{prefix}{q}", "3", "I", "'user:'") for q in (0, 1, 3)])
        return f"{u} AS b2, " + least(f"{prefix}3", moved(f"{prefix}2", "3", "I", "'assistant:'")) + " AS b3"

    step_u = arrive("u", "user", ["t0", "t1", "t3"], "t2")
    step_a = arrive("a", "assistant", ["t2"], "t3")
    step_s = arrive("s", "", ["t0"], "t1")
    # Insertions come before a row: first a user message, or an assistant's, or both in a row.
    twice_u = least("b2", moved("b3", "3", "I", "'user:'"))
    twice_a = least("b3", moved("b2", "3", "I", "'assistant:'"))
    return f"""
WITH RECURSIVE d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
e AS (SELECT *, {crc32} % 20 AS lot FROM d),
f AS (
  SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
    CASE lot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE lot WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM e),
g AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text)) AS i FROM f),
h AS (
  SELECT *, left(role, 1) AS first, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prior FROM g),
k AS (
  SELECT conv_id, i, turn, role, text, first, seen = '' AS blank, seen <> '' AND again AS dup,
    seen <> '' AND NOT again AND right(seen, 1) NOT IN ('.', '!', '?') AS cut, prior IS NOT NULL AND prior || first NOT IN ('su', 'ua', 'au') AS illegal FROM h),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(CAST(blank AS BIGINT)) AS blank,
    sum(CAST(dup AS BIGINT)) AS duplicate, sum(CAST(cut AS BIGINT)) AS truncated, sum(CAST(illegal AS BIGINT)) AS illegal, count(*) AS n FROM k GROUP BY conv_id),
p(conv_id, i, n, s0, s1, s2, s3) AS (
  SELECT conv_id, CAST(1 AS BIGINT), n, CAST({{'c': 0, 'a': '', 'r': ''}} AS {state}), {never}, {never}, {never} FROM facts
  UNION ALL
  SELECT conv_id, i + 1, n, {moved("t0", "4", "D", "")}, {step_s}, {step_u}, {step_a}
  FROM (
    SELECT conv_id, i, n, role, text, first, blank OR dup AS gone, cut, s0 AS t0, s1 AS t1, {twice_u} AS t2, {twice_a} AS t3
    FROM (SELECT *, {inserted("s")} FROM (SELECT p.*, k.role, k.text, k.first, k.blank, k.dup, k.cut FROM p JOIN k ON p.conv_id IS NOT DISTINCT FROM k.conv_id AND p.i = k.i)))),
ended AS (SELECT conv_id, least_of.c AS cost, least_of.a AS audit, least_of.r AS text FROM (
  SELECT conv_id, {least("s0", "b3", twice_a)} AS least_of FROM (SELECT *, {inserted("s")} FROM p WHERE i = n + 1)))
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(CAST(blank AS BIGINT), 0) AS blank, coalesce(CAST(duplicate AS BIGINT), 0) AS duplicate,
  coalesce(CAST(truncated AS BIGINT), 0) AS truncated, coalesce(CAST(illegal AS BIGINT), 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(left(ended.text, greatest(length(ended.text) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM o.conv_id"""
