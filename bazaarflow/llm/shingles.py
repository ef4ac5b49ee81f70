"""Word shingles as 64-bit numbers, computed over whole texts with array operations.

Words are maximal runs of letters, numbers and marks by Unicode class, in lower case; all other characters separate. A letter of
a script that is written without spaces is a word of its own, together with the marks that follow it.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

U = np.uint64
WORDS = 5
_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_WORD = np.zeros(0x80, dtype=bool)
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    _WORD[_c] = True

# Ranges of the scripts without spaces (Thai, Lao, Burmese, Khmer, Tai, Han, Kana, Bopomofo, Yi, Javanese).
NO_SPACES = [
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3005, 0x3007), (0x3021, 0x312F),
    (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x323AF),
]
SEPARATOR, PART, ALONE, MARK = range(4)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, 1 << 17), _powers(_INVERSE, 1 << 17)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def lower_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)


def word_hashes(text: str | None) -> np.ndarray:
    """One number for each word, in order."""
    return placed_words(lower_bytes(text))[1]


@cache
def _kinds() -> np.ndarray:
    """SEPARATOR, PART (of a longer word), ALONE or MARK for each code point; the last entry stands for all beyond."""
    of = {"L": PART, "N": PART, "M": MARK}
    kinds = np.array([of.get(unicodedata.category(chr(c))[0], SEPARATOR) for c in range(0x323B0)] + [SEPARATOR], dtype=np.uint8)
    letters = np.array([unicodedata.category(chr(c))[0] == "L" or c == 0x3007 for c in range(len(kinds))])
    for low, high in NO_SPACES:
        kinds[low : high + 1][letters[low : high + 1]] = ALONE
    return kinds


def code_points(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the bytes of a text, and where each starts."""
    codes = raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass")
    return np.frombuffer(codes, dtype=np.uint32), np.flatnonzero((raw & 0xC0) != 0x80)


def _word_edges(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end in the bytes of a lower-case text."""
    if raw.max() < 0x80:
        edge = np.diff(_WORD[raw].astype(np.int8), prepend=0, append=0)
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    codes, lead = code_points(raw)
    table = _kinds()
    kind = table[np.minimum(codes, len(table) - 1)]
    lead = np.append(lead, len(raw))
    if kind.max() == PART:
        edge = np.diff(kind.astype(np.int8), prepend=0, append=0)
        return lead[np.flatnonzero(edge == 1)], lead[np.flatnonzero(edge == -1)]
    # A mark goes on with whatever it follows.
    mark = kind == MARK
    base = np.maximum.accumulate(np.where(mark, -1, np.arange(len(kind))))
    inside = np.where(base < 0, SEPARATOR, kind[base])
    before = np.concatenate([[SEPARATOR], inside[:-1]])
    start = ~mark & ((inside == ALONE) | ((inside == PART) & (before != PART)))
    # A word ends before the next start or separator.
    stop = np.append(start | (inside == SEPARATOR), True)
    starts, stops = np.flatnonzero(start), np.flatnonzero(stop)
    return lead[starts], lead[stops[np.searchsorted(stops, starts, side="right")]]


def placed_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts in the bytes of a lower-case text, and its number."""
    if not len(raw):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=U)
    starts, ends = _word_edges(raw)
    n = len(raw)
    up, down = (_UP, _DOWN) if n <= len(_UP) else (_powers(_BASE, n), _powers(_INVERSE, n))
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum((raw.astype(U) + U(1)) * up[:n], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))


def shingle_hashes(text: str | None, words: int = WORDS, short: bool = True) -> np.ndarray:
    """One number for each run of ``words`` words, in order.

    A text of fewer words has one shingle of all of them if ``short``, otherwise none; a text without words has none.
    """
    w = word_hashes(text)
    if 0 < len(w) < words:
        return combine(w, len(w)) if short else w[:0]
    return combine(w, words)


def combine(w: np.ndarray, words: int) -> np.ndarray:
    """One number for each window of ``words`` numbers."""
    n = len(w) - words + 1
    if n <= 0:
        return w[:0]
    out = np.full(n, U(words), dtype=U)
    for k in range(words):
        out = out * U(0xD6E8FEB86659FD93) + w[k : k + n]
    return mix(out)
