"""Text columns as flat byte arrays, for vectorised work inside Arrow tasks.

A task sees its texts a few megabytes at a time, whatever the size of an Arrow batch; only a single
longer text makes a longer piece. Words are runs of bytes of one class, so UTF-8 needs no decoding.
Hashes have 64 bits and are the same in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 21

#: Bytes of words parted by ASCII white space (space, tab, line feed, vertical tab, form feed, carriage return).
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words made of ASCII digits, lower-case letters and anything beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each starts; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches, column: str, size: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows, bytes and offsets of consecutive rows holding about ``size`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = flat(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            first = last


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _LOWER[data]


def words(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, breaks: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of each text (one more at the end).

    ``breaks`` marks bytes at which a new word begins in any case; it has one more entry than ``data``.
    """
    if not len(data):
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, np.zeros(len(offsets), np.int64)
    inside = kind[data]
    border = np.zeros(len(data) + 1, bool) if breaks is None else breaks.copy()
    border[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | border[1:-1]
    closes[:-1] &= ~inside[1:] | border[1:-1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """The powers 0 to n - 1 of the hash base, modulo 2**64."""
    table = np.full(max(n, 1), _STEP | np.uint64(1))
    table[0] = 1
    return np.cumprod(table, dtype=np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    within = np.arange(lengths.sum()) - np.repeat(before, lengths)
    terms = _BYTE[data[np.repeat(starts, lengths) + within]] * powers(int(lengths.max()))[within]
    return mix(np.add.reduceat(terms, before) + lengths.astype(np.uint64))


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of each text, and where each text's begin.

    A text of fewer words has its whole sequence as its only shingle; a text without words has none.
    """
    n_words = np.diff(first)
    counts = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    offsets = np.concatenate(([0], np.cumsum(counts)))
    total = int(offsets[-1])
    at = np.repeat(first[:-1], counts) + np.arange(total) - np.repeat(offsets[:-1], counts)
    padded = np.concatenate((hashes, np.zeros(width, np.uint64)))
    out = np.zeros(total, np.uint64)
    for k in range(width):
        out += padded[at + k] * _PLACE[k]
    for text in np.flatnonzero((n_words > 0) & (n_words < width)):
        n = int(n_words[text])
        out[offsets[text]] = (hashes[first[text] : first[text] + n] * _PLACE[:n]).sum(dtype=np.uint64) + _PLACE[32 + n]
    return mix(out), offsets
