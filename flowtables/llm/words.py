"""Hashes of words and of runs of five words, over Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at a time: arrays of eight bytes a byte, a few of them.
CHUNK = 1 << 17
WIDTH = 5

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(int(_RANDOM.integers(1, 1 << 60)) * 8 + 5)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = [np.uint64(int(x) * 2 + 1) for x in _RANDOM.integers(1, 1 << 62, WIDTH)]

#: Letters and digits of ASCII, and every byte of other characters, are of words.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]), dtype=np.uint64)


_POWER, _UNPOWER = _powers(_BASE, CHUNK), _powers(_UNBASE, CHUNK)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread what differs in a few bits over all 64."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of texts, and where each text starts (one more than texts)."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    at = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    if at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64)
    return np.frombuffer(filled.buffers()[2], np.uint8)[at[0] : at[-1]], at - at[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of an array of texts, in order, and where each text starts
    (one more than texts).  Words are runs of ASCII letters and digits and of all
    characters beyond ASCII, in lower case; a null text has none."""
    data, at = text_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    hashes, first = hashes_in(data, at)
    return hashes, np.searchsorted(first, at)


def hashes_in(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in texts' bytes, and the words' first bytes."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = _WORD[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    heads = at[:-1][at[:-1] < at[1:]]
    start[heads] = inside[heads]
    first = np.flatnonzero(start)
    if not len(first):
        return np.zeros(0, np.uint64), first
    gap = np.flatnonzero(~inside)
    # a word ends at the next byte of no word, at the next word's start or at the end
    after = np.searchsorted(gap, first)
    end = np.append(gap, len(data))[after]
    end = np.minimum(end, np.append(first[1:], len(data)))
    out = np.empty(len(first), np.uint64)
    k = 0
    while k < len(first):
        base = first[k]
        if end[k] - base > CHUNK:  # a word longer than a chunk
            out[k] = _long(data[base : end[k]])
            k += 1
            continue
        j = int(np.searchsorted(end, base + CHUNK, "right"))
        part = data[base : end[j - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * _POWER[: len(part)], out=sums[1:])
        a = first[k:j] - base
        out[k:j] = (sums[end[k:j] - base] - sums[a]) * _UNPOWER[a]
        k = j
    return mix64(out), first


def _long(data: np.ndarray) -> np.uint64:
    total, shift = np.uint64(0), 1
    for a in range(0, len(data), CHUNK):
        part = data[a : a + CHUNK]
        total = np.uint64((int(total) + int((_BYTE[part] * _POWER[: len(part)]).sum(dtype=np.uint64)) * shift) % (1 << 64))
        shift = shift * int(_POWER[CHUNK]) % (1 << 64)
    return total


def shingles(words: np.ndarray, starts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of runs of ``width`` words of each text, ascending, and where each
    text's start.  A text of fewer words, but one at least, has one run: all its words."""
    counts = np.diff(starts)
    out, sizes = [], np.zeros(len(counts) + 1, np.int64)
    runs = words[: max(0, len(words) - width + 1)] * _PLACE[0]
    for i in range(1, width):
        runs = runs + words[i : i + len(runs)] * _PLACE[i]
    runs = mix64(runs)
    for i, (a, n) in enumerate(zip(starts[:-1].tolist(), counts.tolist())):
        if n >= width:
            own = np.unique(runs[a : a + n - width + 1])
        elif n:
            own = mix64((words[a : a + n] * np.array(_PLACE[:n])).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
        else:
            continue
        out.append(own)
        sizes[i + 1] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.cumsum(sizes)


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a piece has about ``most`` bytes of text, or one row."""
    for batch in batches:
        column = batch[text].cast(pa.large_string())
        if not len(column):
            continue
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        a = 0
        while a < len(column):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + most, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b
