"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of bytes other than ASCII white space (0x20, 0x09 to 0x0D). Words and runs of
words are represented by 64-bit hashes: two different ones agree with a chance of 2^-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Keeps the first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)
_ODD, _BASE, _END = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD))
_HALF, _PART = np.uint64(32), np.uint64(29)


@dataclass
class Words:
    """``first[d]`` to ``first[d + 1]`` are the words of text ``d``; ``codes`` are their hashes."""

    first: np.ndarray
    codes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def mixed(codes: np.ndarray) -> np.ndarray:
    """The numbers with all bits spread; one to one."""
    codes = (codes ^ (codes >> _HALF)) * _END
    return codes ^ (codes >> _PART)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins; a null text is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, places, data = column.buffers()
    places = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[places[0] : places[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, places - places[0]


def hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each word, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((data.size + 1,), "<u8", padded, strides=(1,))
    codes = lengths.astype(np.uint64) * _ODD
    codes = (codes ^ (eight[starts] & _FIRST[np.minimum(lengths, 8)])) * _BASE
    codes ^= codes >> _HALF
    longer, done = np.flatnonzero(lengths > 8), 8
    while longer.size:
        left = lengths[longer] - done
        step = (codes[longer] ^ (eight[starts[longer] + done] & _FIRST[np.minimum(left, 8)])) * _BASE
        codes[longer] = step ^ (step >> _HALF)
        longer, done = longer[left > 8], done + 8
    return mixed(codes)


def cut(column: pa.Array, lower: bool = False) -> Words:
    """The words of every text of a string column; ``lower`` turns A-Z into a-z first."""
    data, places = text_bytes(column)
    if not data.size:
        return Words(np.zeros(len(places), np.int64), np.zeros(0, np.uint64))
    if lower:
        data = _LOWER[data]
    word = ~_SPACE[data]
    edge = np.zeros(data.size + 1, bool)
    edge[places] = True
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1] | edge[1:-1]
    ends[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(np.searchsorted(starts, places), hashes(data, starts, ends - starts))


def runs(words: Words, length: int, marks: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Starts and hashes of all runs of ``length`` words that lie in one text.

    Also the hashes of the first ``m`` words of each run, for every ``m`` in ``marks``.
    """
    n = words.codes.size - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), [np.zeros(0, np.uint64) for _ in marks]
    ends = np.repeat(words.first[1:], words.counts)[:n]
    inside = np.flatnonzero(np.arange(n) + length <= ends)
    code, kept = words.codes[:n].copy(), {1: words.codes[:n]}
    for i in range(1, length):
        code *= _BASE
        code += words.codes[i : n + i]
        if i + 1 in marks:
            kept[i + 1] = code.copy()
    return inside, mixed(code[inside]), [mixed(kept[m][inside]) for m in marks]
