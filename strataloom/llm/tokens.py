"""Hashes of the words of whole Arrow columns of text, made with numpy over the bytes and not word by word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

END = -(2**63)  # stands for the end of a text; hashes of words never take it
_BASE = 0x9E3779B97F4A7C15 | 1
_PIECE = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _codes() -> np.ndarray:
    """A byte's value plus one, A-Z as a-z; 0 for space and 0x09-0x0D, which separate words."""
    codes = np.arange(1, 257, dtype=np.uint64)
    codes[65:91] += 32
    codes[[32, *range(9, 14)]] = 0
    return codes


_CODES = _codes()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER, _INVERSE = _powers(_BASE, 1), _powers(pow(_BASE, -1, 2**64), 1)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows, from 0 on) and bytes of a string column; null is empty."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw


def _pieces(offsets: np.ndarray, raw: np.ndarray):
    """Ranges of bytes of about _PIECE that end at the end of a row or behind a separator, whatever the length of a text."""
    start = 0
    while start < len(raw):
        stop = min(start + _PIECE, len(raw))
        if stop < len(raw):
            row = offsets[np.searchsorted(offsets, stop, "right") - 1]
            if row > start:
                stop = int(row)
            else:
                gaps = np.flatnonzero(_CODES[raw[start:stop]] == 0)
                if len(gaps):
                    stop = start + int(gaps[-1]) + 1
                else:  # a word longer than a piece
                    end = int(offsets[np.searchsorted(offsets, start, "right")])
                    gaps = np.flatnonzero(_CODES[raw[stop:end]] == 0)
                    stop = stop + int(gaps[0]) + 1 if len(gaps) else end
        yield start, stop
        start = stop


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of all texts laid end to end: 64-bit hashes of their words, END behind each text; and how many of these each text has.

    A word is a run of bytes between space and 0x09-0x0D, A-Z lower-cased. Its hash is a polynomial in its bytes, from prefix sums modulo 2**64, mixed with its length.
    """
    global _POWER, _INVERSE
    offsets, raw = _bytes_of(column)
    found, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    for start, stop in _pieces(offsets, raw):
        n = stop - start
        if len(_POWER) <= n:
            _POWER, _INVERSE = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 2**64), n + 1)
        codes = _CODES[raw[start:stop]]
        full = codes > 0
        first, last = full.copy(), full.copy()
        first[1:] &= ~full[:-1] | cut[start + 1 : stop]
        last[:-1] &= ~full[1:] | cut[start + 1 : stop]
        sums = np.cumsum(codes * _POWER[:n], dtype=np.uint64)
        a, b = np.flatnonzero(first), np.flatnonzero(last)
        value = (sums[b] - np.where(a > 0, sums[a - 1], np.uint64(0))) * _INVERSE[a]
        found.append(mix(value + (b - a + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64))
        ends.append(b + start + 1)
    words, ends = np.concatenate(found), np.concatenate(ends)
    words[words == END] += 1
    upto = np.searchsorted(ends, offsets[1:], "right")  # words that end at or before the end of each text
    out = np.full(len(words) + len(column), END, np.int64)
    inside = np.ones(len(out), bool)
    inside[upto + np.arange(len(column))] = False
    out[inside] = words
    return out, np.diff(np.concatenate([[0], upto])) + 1


class Lookup:
    """Places of keys in an array of distinct ones; -1 for those that it lacks. Open addressing, all keys at a time; a small table of flags tells most that it lacks."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.mask = (1 << max(4, (2 * len(keys)).bit_length())) - 1
        self.slots = np.full(self.mask + 1, -1, np.int32)
        self.flags = np.zeros(1 << max(4, (4 * len(keys)).bit_length()), bool)
        self.flags[self._flag(keys)] = True
        at, open_ = self._home(keys), np.arange(len(keys), dtype=np.int32)
        while len(open_):
            here = at[open_]
            free = self.slots[here] < 0
            self.slots[here[free]] = open_[free]
            open_ = open_[self.slots[here] != open_]
            at[open_] = (at[open_] + 1) & self.mask

    def _home(self, x: np.ndarray) -> np.ndarray:
        return ((x.view(np.uint64) >> np.uint64(17)).view(np.int64) ^ x) & self.mask

    def _flag(self, x: np.ndarray) -> np.ndarray:
        return (x >> np.int64(20)) & (len(self.flags) - 1)

    def hits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of x the array has, rising, and their places there."""
        which = np.flatnonzero(self.flags[self._flag(x)])
        if not len(self.keys):
            return which, which
        x = x[which]
        out, at, open_ = np.full(len(x), -1, np.int32), self._home(x), np.arange(len(x))
        while len(open_):
            slot = self.slots[at]
            full = slot >= 0
            hit = full & (self.keys[slot] == (x if len(open_) == len(x) else x[open_]))
            out[open_[hit]] = slot[hit]
            more = np.flatnonzero(full & ~hit)
            open_, at = open_[more], (at[more] + 1) & self.mask
        ok = out >= 0
        return which[ok], out[ok]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), -1, np.int64)
        which, at = self.hits(x)
        out[which] = at
        return out
