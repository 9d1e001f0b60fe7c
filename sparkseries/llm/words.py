"""Words, lines and their hashes over Arrow batches of texts, by numpy on the raw UTF-8 bytes.

Every function here works inside one task on a bounded slice of rows. A word's hash is a
polynomial of random byte values modulo 2**64, mixed at the end; equal words have equal hashes
in every task. A slice holds `SLICE_BYTES` bytes or one text, whichever is more; memory is about
60 bytes per byte of a slice, and 20 per byte of a text that is longer than that.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

# Bytes that separate words under [^\x20\x09-\x0D]+
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


class Alphabet(NamedTuple):
    """Which bytes belong to words, and the hash value of each byte (0 outside words)."""

    inside: np.ndarray
    values: np.ndarray


def alphabet(word_bytes: np.ndarray, lower: bool) -> Alphabet:
    values = _BYTE_VALUES.copy()
    inside = word_bytes.copy()
    if lower:
        values[65:91] = values[97:123]
        inside[65:91] = inside[97:123]
    values[~inside] = 0
    return Alphabet(inside, values)


_ANY = np.ones(256, bool)
_ANY[list(SPACES)] = False
_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[97:123] = _ALNUM[128:] = True

SPACED = alphabet(_ANY, lower=False)  # [^\x20\x09-\x0D]+
SPACED_LOWER = alphabet(_ANY, lower=True)  # the same after lower-casing A-Z
ALNUM_LOWER = alphabet(_ALNUM, lower=True)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
_LINE = np.ones(256, bool)
_LINE[10] = False
LINES = alphabet(_LINE, lower=False)

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 2 * SLICE_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


class Texts(NamedTuple):
    """A slice of rows: first row number, all bytes, and each text's byte offsets (n + 1)."""

    row: int
    data: np.ndarray
    offsets: np.ndarray


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Cut a string column into slices of about `limit` bytes; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield Texts(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


class Words(NamedTuple):
    """Hash, byte range and text number of each word; `first[i]` is the first word of text i."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def spans(texts: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of maximal runs of `inside` bytes; a run ends with its text."""
    flags = np.zeros(len(texts.data) + 1, bool)
    flags[:-1] = inside[texts.data]
    before = np.empty(len(flags), bool)
    before[0] = False
    before[1:] = flags[:-1]
    breaks = texts.offsets[1:-1]
    begins = flags & ~before
    ends = before & ~flags
    cut = breaks[flags[breaks] & before[breaks]]
    begins[cut] = True
    ends[cut] = True
    return np.flatnonzero(begins), np.flatnonzero(ends)


def words(texts: Texts, letters: Alphabet) -> Words:
    start, end = spans(texts, letters.inside)
    text = np.searchsorted(texts.offsets, start, side="right") - 1
    first = np.searchsorted(start, texts.offsets, side="left")
    first[-1] = len(start)
    if not len(start):
        return Words(np.zeros(0, np.uint64), start, end, text, first)
    sums = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):  # once, but for texts longer than a slice
        base = start[i]
        j = max(i + 1, int(np.searchsorted(start, base + SLICE_BYTES)))
        stop = start[j] if j < len(start) else len(texts.data)
        up, down = powers(stop - base)
        own = start[i:j] - base
        sums[i:j] = np.add.reduceat(letters.values[texts.data[base:stop]] * up, own) * down[own]
        i = j
    return Words(mix(sums), start, end, text, first)


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n words from each position on, and whether all n are in the same text."""
    size = len(w.hash)
    out = np.zeros(size, np.uint64)
    ok = np.zeros(size, bool)
    if size < n:
        return out, ok
    acc = np.zeros(size - n + 1, np.uint64)
    step = 1
    for j in range(n):
        acc += w.hash[j : size - n + 1 + j] * np.uint64(step)
        step = step * _BASE & _MASK
    out[: size - n + 1] = mix(acc)
    ok[: size - n + 1] = w.text[: size - n + 1] == w.text[n - 1 :]
    return out, ok


def hash_words(texts: list[str], letters: Alphabet) -> list[np.ndarray]:
    """Word hashes of a few texts."""
    out = []
    for part in slices(pa.array(texts, pa.large_string())):
        w = words(part, letters)
        out += [w.hash[a:b] for a, b in zip(w.first, w.first[1:])]
    return out


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text, for `first` as in Words or byte offsets."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
