"""Benchmark decontamination by templates, so that re-parameterised questions are found too.

Every token of a text becomes a template token: numbers, units after a number and names (words
with a capital inside a sentence) turn into typed placeholders, other words lose case and the
punctuation around them. Windows of ``window`` template tokens are hashed and the windows of a
block of benchmark items, of bounded size, are the build side of a hash join with those of all
texts; larger benchmarks take several blocks. Items shorter than a window count as one window;
items of fewer than ``SHORTEST`` tokens say too little and never match. A window with too few
words that are no placeholders (``LITERAL``) says nothing as a template and counts by its very
numbers, units and names instead, so that tables of numbers match only where the numbers do.

Texts and items have two readings, and windows of both count. In the first a capital at the start of
a sentence is an ordinary word. In the second it is a name, and names in a row are one placeholder,
so that a name may begin a sentence and may have another number of words.

Matching windows are aligned: those of one text and one item at the same distance belong together,
and so do those at neighbouring distances (at most ``DRIFT`` apart), between which words were put in
or left out. An item of less than two windows also matches where all of it but one changed, added
or missing token is there; one of its halves finds the place. An alignment is a leak if it covers at
least ``coverage`` of the item's tokens and its slots are consistent: one value of the item always
stands for one value of the text. An item copied word for word is trivially consistent.

Null and empty texts match nothing, and neither do null items. Repeated rows give repeated results.
Rows with a null id are judged and keep their null id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packwright.llm.frames import batch, keyed, steps, task_map
from packwright.llm.words import Words, hashes, mixed, runs, text_bytes

#: Items of one block of the benchmark.
ITEMS = 20_000
#: Tokens an item needs.
SHORTEST = 4
#: One in so many tokens of a window is an ordinary word, or its placeholders do not count.
LITERAL = 4
#: Tokens by which neighbouring distances of one alignment differ, at most.
DRIFT = 8

# Units of measure that may follow a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ounce ounces pound pounds ml l liter liters litre litres "
    "gallon gallons second seconds minute minutes hour hours day days week weeks month months year years percent % degree degrees "
    "celsius fahrenheit dollar dollars cent cents euro euros usd eur gbp mph kmh watt watts volt volts joule joules hz khz mhz ghz kb mb gb tb"
).split()

# Number words; those that are other words too in one of the languages are left out.
NUMBERS = (
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand million "
    "null zwei drei vier sieben acht neun zehn zwanzig dreißig vierzig hundert tausend "
    "deux trois quatre cinq sept huit dix onze douze vingt trente quarante cinquante cent mille "
    "cero dos tres cuatro cinco seis siete ocho nueve diez veinte treinta cuarenta cincuenta cien ciento mil "
    "два две три четыре пять шесть семь восемь девять десять двадцать сто"
).split()

_NUMBER, _UNIT, _NAME = (np.uint64(x) for x in (0x6E756D62, 0x756E6974, 0x6E616D65))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_STRIP = np.zeros(256, bool)
_STRIP[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) != "%"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Template:
    """Template codes of all tokens, the values behind them, and which are slots.

    ``begins`` are capitals at the start of a sentence, ``joins`` names that go on a row of names;
    ``words`` is the first word of each token, and the number of words at the end.
    """

    first: np.ndarray
    codes: np.ndarray
    values: np.ndarray
    slots: np.ndarray
    begins: np.ndarray
    joins: np.ndarray
    words: np.ndarray


def _word_codes(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    lengths = np.array([len(w.encode()) for w in words])
    return hashes(data, np.cumsum(lengths) - lengths, lengths)


_UNIT_CODES = np.sort(_word_codes(UNITS))
_NUMBER_CODES = np.sort(_word_codes(NUMBERS))


def _is_one_of(values: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return codes[np.minimum(np.searchsorted(codes, values), codes.size - 1)] == values


def _capitals(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where capitals begin, and the bytes in lower case: ASCII, Latin-1, Greek and Cyrillic."""
    lowered, after = _LOWER[data], np.r_[data[1:], np.uint8(0)]
    capital = (data >= 65) & (data <= 90)
    latin = (data == 0xC3) & (after >= 0x80) & (after <= 0x9E) & (after != 0x97)
    # Greek and Cyrillic: the first half moves up within its lead byte, the second into the next one.
    near = ((data == 0xCE) & (after >= 0x91) & (after <= 0x9F)) | ((data == 0xD0) & (after >= 0x90) & (after <= 0x9F))
    far = ((data == 0xCE) & (after >= 0xA0) & (after <= 0xA9)) | ((data == 0xD0) & (after >= 0xA0) & (after <= 0xAF))
    up = np.flatnonzero(latin | near)
    lowered[up + 1] += 0x20
    up = np.flatnonzero(far)
    lowered[up] += 1
    lowered[up + 1] -= 0x20
    return capital | latin | near | far, lowered


def canonical(column: pa.Array) -> Template:
    """The templates of a column of texts."""
    data, places = text_bytes(column)
    if not data.size:
        none = np.zeros(0, np.uint64)
        return Template(np.zeros(len(places), np.int64), none, none, *[np.zeros(0, bool)] * 3, np.zeros(1, np.int64))
    word = ~_SPACE[data]
    edge = np.zeros(data.size + 1, bool)
    edge[places] = True
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1] | edge[1:-1]
    ends[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    first = np.searchsorted(starts, places)
    # Sentences begin with a text, after a line break, and after a stop.
    breaks = np.cumsum(data == 0x0A)
    opens = np.zeros(starts.size, bool)
    opens[first[:-1][first[:-1] < first[1:]]] = True
    opens[1:] |= _STOP[data[ends[:-1] - 1]] | (breaks[starts[1:]] > breaks[ends[:-1] - 1])
    # Punctuation around a word goes, unless nothing else is left.
    low, high = starts.copy(), ends.copy()
    live = np.arange(low.size)
    while live.size:
        live = live[(low[live] < ends[live] - 1) & _STRIP[data[low[live]]]]
        low[live] += 1
    live = np.arange(high.size)
    while live.size:
        live = live[(high[live] > low[live] + 1) & _STRIP[data[high[live] - 1]]]
        high[live] -= 1
    capital, lowered = _capitals(data)
    values = hashes(lowered, low, high - low)
    digits = np.r_[0, np.cumsum(_DIGIT[data])]
    number = (digits[high] > digits[low]) | _is_one_of(values, _NUMBER_CODES)
    unit = np.zeros(number.size, bool)
    unit[1:] = number[:-1] & _is_one_of(values, _UNIT_CODES)[1:] & ~number[1:]
    unit[first[:-1][first[:-1] < first[1:]]] = False
    name = capital[low] & ~opens & ~number & ~unit
    codes = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, values)))
    begins = capital[low] & opens & ~number & ~unit
    joins = np.zeros(name.size, bool)
    joins[1:] = name[1:] & (name | begins)[:-1] & (high == ends)[:-1] & (low == starts)[1:]
    return Template(first, codes, values, number | unit | name, begins, joins, np.arange(name.size + 1))


def folded(plain: Template) -> Template:
    """The second reading: capitals at the start of a sentence are names, names in a row are one token."""
    at = np.flatnonzero(~plain.joins)
    words = np.r_[at, plain.joins.size]
    sizes, values = np.diff(words), plain.values[at].copy()
    longer, done = np.flatnonzero(sizes > 1), 1
    while longer.size:
        values[longer] = mixed(values[longer]) + plain.values[at[longer] + done]
        done += 1
        longer = longer[sizes[longer] > done]
    slots = plain.slots[at] | (sizes > 1)
    codes = np.where(plain.begins[at] | (sizes > 1), _NAME, plain.codes[at])
    return Template(np.searchsorted(at, plain.first), codes, values, slots, plain.begins[at], np.zeros(at.size, bool), words)


def readings(column: pa.Array) -> list[Template]:
    """Both readings of a column of texts."""
    plain = canonical(column)
    return [plain, folded(plain)]


Windows = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass
class Block:
    """Windows of some benchmark items, sorted by hash within each length, and halves of short items; of both readings."""

    items: np.ndarray
    templates: list[Template]
    windows: list[Windows]
    halves: list[Windows]


def index(items: list[tuple], window: int) -> Block:
    """The windows of ``(item_id, text)`` pairs."""
    templates = readings(pa.array([t for _, t in items], pa.string()))
    return Block(np.array([i for i, _ in items], np.int64), templates, [_windows(t, window) for t in templates], [_halves(t, window) for t in templates])


def _sorted(codes: np.ndarray, owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    return codes[order], owner[order], place[order]


def _codes(template: Template, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and codes of all windows of ``length`` tokens: templates, or the values of those that are mostly slots."""
    starts, codes, _ = runs(Words(template.first, template.codes), length)
    words = np.r_[0, np.cumsum((template.codes != _NUMBER) & (template.codes != _UNIT) & (template.codes != _NAME))]
    empty = (words[starts + length] - words[starts]) * LITERAL < length
    if empty.any():
        _, values, _ = runs(Words(template.first, template.values), length)
        codes = np.where(empty, mixed(values ^ _NAME), codes)
    return starts, codes


def _windows(template: Template, window: int) -> Windows:
    sizes, found = np.diff(template.first), {}
    for length in sorted({window} | {int(s) for s in sizes if SHORTEST <= s < window}):
        starts, codes = _codes(template, length)
        owner = np.repeat(np.arange(sizes.size), sizes)[starts]
        use = sizes[owner] >= window if length == window else sizes[owner] == length
        if use.any():
            found[length] = _sorted(codes[use], owner[use], (starts - template.first[owner])[use])
    return found


def _halves(template: Template, window: int) -> Windows:
    """First and last halves of items of one to two windows."""
    sizes, found = np.diff(template.first), {}
    for length in sorted({int(s) // 2 for s in sizes if window <= s < 2 * window and s >= 2 * SHORTEST}):
        starts, codes = _codes(template, length)
        owner = np.repeat(np.arange(sizes.size), sizes)[starts]
        place = starts - template.first[owner]
        use = (sizes[owner] // 2 == length) & (sizes[owner] >= window) & (sizes[owner] < 2 * window) & ((place == 0) | (place == sizes[owner] - length))
        found[length] = _sorted(codes[use], owner[use], place[use])
    return found


def _matches(template: Template, windows: Windows) -> np.ndarray:
    """Matching windows as rows of text, item, place in the text, place in the item, length."""
    rows = []
    for length, (codes, owner, place) in windows.items():
        starts, own = _codes(template, length)
        low = np.searchsorted(codes, own, "left")
        hit = np.flatnonzero((low < codes.size) & (codes[np.minimum(low, codes.size - 1)] == own))
        if not hit.size:
            continue
        counts = np.searchsorted(codes, own[hit], "right") - low[hit]
        each = np.repeat(np.arange(hit.size), counts)
        at = low[hit][each] + np.arange(each.size) - np.repeat(np.cumsum(counts) - counts, counts)
        start = starts[hit][each]
        text = np.searchsorted(template.first, start, "right") - 1
        rows.append(np.stack([text, owner[at], start - template.first[text], place[at], np.full(each.size, length)], 1))
    return np.concatenate(rows) if rows else np.zeros((0, 5), np.int64)


def _consistent(ours: np.ndarray, theirs: np.ndarray) -> float:
    """Share of slots whose value of the text is the usual one for their value of the item."""
    if not ours.size:
        return 1.0
    pairs, counts = np.unique(np.stack([theirs, ours], 1), axis=0, return_counts=True)
    _, group = np.unique(pairs[:, 0], return_inverse=True)
    best = np.zeros(group.max() + 1, np.int64)
    np.maximum.at(best, group, counts)
    return float(best.sum() / ours.size)


#: Tokens of an item and of a text that stand for each other, in one reading.
Claim = tuple[int, np.ndarray, np.ndarray]


def _one_edit(ours: Template, theirs: Template, found: np.ndarray, reading: int):
    """``(text, item, claims)`` where all of a short item but one changed, added or missing token is there."""
    if not found.size:
        return
    text, item, at, place = np.unique(found[:, :4], axis=0).T
    size, begin, low, high = theirs.first[item + 1] - theirs.first[item], theirs.first[item], ours.first[text], ours.first[text + 1]
    steps = np.arange(int(size.max()))

    def equal(shift):
        """Whether each token of the item equals that of the text ``shift`` places on."""
        there = (low + shift)[:, None] + steps
        inside = (steps < size[:, None]) & (there >= low[:, None]) & (there < high[:, None])
        mine = theirs.codes[np.minimum(begin[:, None] + steps, theirs.codes.size - 1)]
        return inside & (ours.codes[np.clip(there, 0, ours.codes.size - 1)] == mine)

    for change in (0, 1, -1):
        front = np.where(place == 0, at, at - place - change)
        back = np.where(place == 0, at + change, at - place)
        head = np.cumprod(equal(front), 1).sum(1)
        tail = np.cumprod((equal(back) | (steps >= size[:, None]))[:, ::-1], 1).sum(1) - (steps.size - size)
        for k in np.flatnonzero(head + tail >= size - (change < 1)):
            p = int(head[k])
            i = np.r_[np.arange(p), np.arange(max(p, size[k] - tail[k]), size[k])]
            yield int(text[k]), int(item[k]), [(reading, begin[k] + i, low[k] + i + np.where(np.arange(i.size) < p, front[k], back[k]))]


def _judge(texts: list[Template], block: Block, item: int, claims: list[Claim], coverage: float, consistency: float) -> tuple | None:
    """Covered tokens, coverage, slots, consistency and verbatim of an alignment if it is a leak; earlier claims go first."""
    start, stop = (int(x) for x in block.templates[0].first[item : item + 2])
    covered, mine, yours, slots, opened = np.zeros(stop - start, bool), [], [], [], []
    for reading, theirs, ours in claims:
        text, bench = texts[reading], block.templates[reading]
        low, high = bench.words[theirs] - start, bench.words[theirs + 1] - start
        taken = np.r_[0, np.cumsum(covered)]
        new = taken[high] - taken[low] < high - low
        theirs, ours, low, high = theirs[new], ours[new], low[new], high[new]
        for a, b in zip(low.tolist(), high.tolist(), strict=True):
            covered[a:b] = True
        mine.append(text.values[ours])
        yours.append(bench.values[theirs])
        slots.append(text.slots[ours])
        opened.append(text.begins[ours] & bench.begins[theirs])
    count, size = int(covered.sum()), stop - start
    if count < coverage * size:
        return None
    mine, yours, slots, opened = (np.concatenate(x) for x in (mine, yours, slots, opened))
    slots |= mine != yours
    slots |= opened & np.isin(yours, yours[slots])  # the names that begin sentences
    even, same = _consistent(mine[slots], yours[slots]), bool((mine == yours).all())
    return (count, count / size, int(slots.sum()), even, same) if same or even >= consistency else None


def _joined(shifts: list[tuple[int, Claim]]):
    """Claims of neighbouring distances together, the largest first."""
    shifts = sorted(shifts, key=lambda x: x[0])
    at = 0
    for k in range(1, len(shifts) + 1):
        if k == len(shifts) or shifts[k][0] - shifts[k - 1][0] > DRIFT:
            if k - at > 1:
                yield [c for _, c in sorted(shifts[at:k], key=lambda x: (-x[1][1].size, x[1][0], x[0]))]
            at = k


def leaks_of(texts: list[Template], block: Block, coverage: float, consistency: float):
    """``(text, item, covered tokens, coverage, slots, consistency, verbatim)`` of each leak."""
    best: dict[tuple[int, int], tuple] = {}
    shifts: dict[tuple[int, int], list[tuple[int, Claim]]] = {}

    def judge(text, item, claims):
        row = _judge(texts, block, item, claims, coverage, consistency)
        if row is not None:
            best[text, item] = max(row, best.get((text, item), row))

    for reading, (ours, theirs) in enumerate(zip(texts, block.templates, strict=True)):
        found = _matches(ours, block.windows[reading])
        found = found[np.lexsort((found[:, 3], found[:, 2] - found[:, 3], found[:, 1], found[:, 0]))]
        key = np.stack([found[:, 0], found[:, 1], found[:, 2] - found[:, 3]], 1)
        cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)]) if found.size else np.zeros(0, int)
        for a, b in zip(cuts, np.r_[cuts[1:], len(found)] if cuts.size else cuts, strict=True):
            text, item, shift = (int(x) for x in key[a])
            tokens = np.unique((found[a:b, 3, None] + np.arange(found[a, 4])).ravel())
            claim = reading, theirs.first[item] + tokens, ours.first[text] + tokens + shift
            judge(text, item, [claim])
            # Both readings are compared by words.
            far = int(ours.words[claim[2][0]] - texts[0].first[text] - theirs.words[claim[1][0]] + block.templates[0].first[item])
            shifts.setdefault((text, item), []).append((far, claim))
        for text, item, claims in _one_edit(ours, theirs, _matches(ours, block.halves[reading]), reading):
            judge(text, item, claims)
    for (text, item), found in shifts.items():
        for claims in _joined(found):
            judge(text, item, claims)
    for (text, item), row in sorted(best.items()):
        yield text, item, *row


def leaks(
    df: DataFrame,
    benchmark: DataFrame,
    window: int = 8,
    coverage: float = 0.5,
    consistency: float = 0.9,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    items_per_block: int = ITEMS,
) -> DataFrame:
    """One row for every pair of a text and an item that it leaks.

    ``(id_col, item_id, matched_tokens, coverage, n_slots, slot_consistency, verbatim)``, of
    several alignments the best. Only one block of items at a time is with the driver.
    """
    kind, spark = dict(df.dtypes)[id_col], df.sparkSession
    texts = keyed(df, id_col, text_col)
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).dropna().distinct()
    blocks = max(1, -(-items.count() // items_per_block))
    fields = [("item_id", pa.int64()), ("matched_tokens", pa.int32()), ("coverage", pa.float64()), ("n_slots", pa.int32()), ("slot_consistency", pa.float64()), ("verbatim", pa.bool_())]

    def over(block):
        def run(batches):
            for part in steps(batches):
                rows = list(leaks_of(readings(part.column("text")), block.value, coverage, consistency))
                if not rows:
                    continue
                schema = pa.schema([part.schema.field("id"), *fields])
                ids = part.column("id").take(pa.array([r[0] for r in rows]))
                columns = list(zip(*rows, strict=True))[1:]
                yield batch(schema, id=ids, item_id=[int(block.value.items[i]) for i in columns[0]], matched_tokens=columns[1], coverage=columns[2],
                            n_slots=columns[3], slot_consistency=columns[4], verbatim=columns[5])

        return run

    found = None
    for number in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).orderBy("item_id", "text").collect()
        block = spark.sparkContext.broadcast(index([(r["item_id"], r["text"]) for r in own], window))
        part = task_map(texts, over(block), f"id {kind}, item_id bigint, matched_tokens int, coverage double, n_slots int, slot_consistency double, verbatim boolean")
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("id", id_col)


def clean(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of the texts that leak no item; rows with a null id are kept only if clean."""
    bad = leaks(df, benchmark, id_col=id_col, text_col=text_col, **options).select(F.col(id_col).alias("bad_id")).distinct()
    return df.join(bad, df[id_col].eqNullSafe(bad["bad_id"]), "left_anti")
