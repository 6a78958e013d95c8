"""Words of whole Arrow columns in numpy: boundaries and 64-bit hashes, without a Python object per word.

A word's hash is a polynomial in its bytes modulo 2**64, from running sums over the buffer, then mixed.
Texts are read in chunks of about CHUNK bytes; a longer text is cut at separators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _lower(byte: int) -> int:
    return byte + 32 if 65 <= byte <= 90 else byte


_ALL = np.arange(256)
#: Words of the contract [^\x20\x09-\x0D]+ and of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z, as masks over UTF-8 bytes.
SPACED = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
ALNUM = (_ALL >= 0x80) | ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | ((_ALL >= 0x41) & (_ALL <= 0x5A))
_VALUE = np.array([_lower(b) + 1 for b in range(256)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        _powers[:] = [np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, b, dtype=np.uint64)))) for b in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text starts and the last ends; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    where = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)), where


def pieces(data: np.ndarray, where: np.ndarray, inside: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, text starts within) of chunks that end where a text or a word ends."""
    at, end = int(where[0]), int(where[-1])
    while at < end:
        to = min(end, at + CHUNK)
        if to < end:
            back = int(where[np.searchsorted(where, to, "right") - 1])
            if back > at:
                to = back
            else:  # one long text: go back to a separator, or on to the next
                stops = np.flatnonzero(~inside[data[at:to]])
                if len(stops):
                    to = at + int(stops[-1]) + 1
                else:
                    stop = int(where[np.searchsorted(where, at, "right")])
                    while to < stop and inside[data[to]]:
                        to += 1
        yield at, to, where[np.searchsorted(where, at, "left") : np.searchsorted(where, to, "left")]
        at = to


def spans(data: np.ndarray, at: int, to: int, starts_in: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in data[at:to], relative to at, and their hashes."""
    part = data[at:to]
    n = len(part)
    m = inside[part]
    before, after = np.empty(n, dtype=bool), np.empty(n, dtype=bool)
    before[0], before[1:] = False, m[:-1]
    after[-1], after[:-1] = False, m[1:]
    edge = starts_in - at
    before[edge[edge < n]] = False
    after[edge[edge > 0] - 1] = False
    begin, end = np.flatnonzero(m & ~before), np.flatnonzero(m & ~after) + 1
    power, inverse = _tables(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUE[part] * power[:n], out=total[1:])
    h = (total[end] - total[begin]) * inverse[begin]
    return begin, end, mix(h + (end - begin).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def hashes(texts: pa.Array, inside: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts in order, and where each text's words start and the last end."""
    data, where = buffers(texts)
    found, begins = [], []
    for at, to, starts_in in pieces(data, where, inside):
        begin, _, h = spans(data, at, to, starts_in, inside)
        found.append(h)
        begins.append(begin + at)
    if not found:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(where), dtype=np.int64)
    return np.concatenate(found), np.searchsorted(np.concatenate(begins), where, "left")


def one_hash(word: bytes) -> int:
    """The hash of a single word, as in hashes()."""
    h, _ = hashes(pa.array([word.decode("utf-8", "replace")]), np.ones(256, dtype=bool))
    return int(h[0])


class Lookup:
    """Where a 64-bit hash stands in an array of distinct ones (-1: nowhere), by a slot table and a search for the rest."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.uint64(max(10, int(len(keys) * 4).bit_length()))
        self.slot = np.full(1 << int(self.bits), -1, dtype=np.int32)
        at = (keys >> (np.uint64(64) - self.bits)).astype(np.int64)
        self.slot[at] = np.arange(len(keys), dtype=np.int32)
        lost = np.flatnonzero(self.slot[at] != np.arange(len(keys)))
        self.more = lost[np.argsort(keys[lost], kind="stable")].astype(np.int32)
        self.more_keys = keys[self.more]
        self.crowded = np.zeros(1 << int(self.bits), dtype=bool)
        self.crowded[at[lost]] = True

    def __call__(self, h: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(h), -1, dtype=np.int32)
        at = (h >> (np.uint64(64) - self.bits)).astype(np.int64)
        found = self.slot[at]
        wrong = self.keys[found] != h
        found[wrong] = -1
        if len(self.more):
            again = np.flatnonzero(wrong & self.crowded[at])
            place = np.minimum(np.searchsorted(self.more_keys, h[again]), len(self.more) - 1)
            found[again] = np.where(self.more_keys[place] == h[again], self.more[place], -1)
        return found
