"""Words, word hashes and window hashes shared by the text operators. Runs inside tasks.

A word is a maximal run of bytes other than space and the controls 0x09-0x0D, which is how
`bytes.split()` cuts. Null texts have no words.
"""

from __future__ import annotations

import numpy as np

PIECE_BYTES = 1 << 19
MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased; other letters keep their case."""
    return text.encode("utf-8").lower().split() if text else []


_TABLE = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {1: np.ones(1, np.uint64), -1: np.ones(1, np.uint64)}


def _power(n: int, sign: int) -> np.ndarray:
    """MULTIPLIER to the powers 0, 1, ... (or 0, -1, ...), at least n of them."""
    if len(_powers[sign]) < n:
        factors = np.full(max(n, PIECE_BYTES), pow(MULTIPLIER, sign, _MASK + 1), np.uint64)
        factors[0] = 1
        _powers[sign] = np.multiply.accumulate(factors)
    return _powers[sign][:n]


def _hashes_of(raw: np.ndarray) -> np.ndarray:
    inside = ~SPACES[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begin, end = edges[::2], edges[1::2]
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[raw] * _power(len(raw), 1), out=total[1:])
    return mix((total[end] - total[begin]) * _power(len(raw), -1)[begin] + (end - begin).astype(np.uint64))


def text_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """A 64-bit hash per word of a text, in order, whatever the words around it.

    A polynomial over the word's bytes, taken from running sums over the whole text. Long texts are
    cut at spaces, so the sums stay short.
    """
    if not text:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(text.encode("utf-8").lower() if lower else text.encode("utf-8"), np.uint8)
    if len(raw) <= PIECE_BYTES:
        return _hashes_of(raw)
    spaces, parts, begin = np.flatnonzero(SPACES[raw]), [], 0
    while begin < len(raw):
        end = len(raw)
        if begin + PIECE_BYTES < end:
            i = np.searchsorted(spaces, begin + PIECE_BYTES)
            if i and spaces[i - 1] > begin:
                end = int(spaces[i - 1])
            elif i < len(spaces):  # one word longer than a piece
                end = int(spaces[i])
        parts.append(_hashes_of(raw[begin:end]))
        begin = end
    return np.concatenate(parts)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all bits."""
    x = values ^ (values >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of `size` words, in order; none if there are fewer words.

    The polynomial over the words' hashes is put together from runs of powers of two.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, run, length = np.zeros(n, np.uint64), 0, hashes, 1
    while done < size:
        if size & length:
            out += run[done:done + n] * np.uint64(pow(MULTIPLIER, done, _MASK + 1))
            done += length
        if done < size:
            run = run[:-length] + run[length:] * np.uint64(pow(MULTIPLIER, length, _MASK + 1))
            length *= 2
    return mix(out)


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n words lie in a window of `size` words that starts at one of `starts`."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + size, n), -1)
    return np.cumsum(edges[:-1]) > 0


def repeated(values: np.ndarray) -> np.ndarray:
    """Which values occur at least twice."""
    if len(values) < 2:
        return np.zeros(len(values), dtype=bool)
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(values), dtype=bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out
