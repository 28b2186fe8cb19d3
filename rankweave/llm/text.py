"""Text columns as byte buffers: rows in bounded pieces, words, word hashes and n-gram hashes, all by numpy.

These helpers run inside tasks on the Arrow batches that Spark hands over. A batch is worked on in pieces of about
`PIECE_BYTES` of text, so that the scratch arrays stay small whatever the batch holds; a single longer text makes a
piece of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 18

_RANDOM = np.random.default_rng(20240607)
_BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_SHINGLE_FACTORS = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over batches that hands freed memory back to the system at its end.

    Spark keeps Python workers for later tasks, and several of them wait beside each running one."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than GNU's
        pass


def byte_table(members) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: The separators of the word pattern `[^\x20\x09-\x0D]+`.
SPACES = byte_table([0x20, *range(0x09, 0x0E)])
#: ASCII letters in lower case; other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and len + 1 offsets into them. A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def pieces(column, limit: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of rows with at most `limit` bytes together."""
    limit = limit or PIECE_BYTES
    data, offsets = utf8(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the maximal runs of true bytes within each row."""
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    edges = offsets[:-1][offsets[:-1] < len(inside)]
    before = np.empty(len(inside), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(inside), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal spans wherever they stand."""
    if not len(starts):
        return np.empty(0, np.uint64)
    size = max(PIECE_BYTES, len(data)) + 1
    if size not in _POWERS:
        if size > PIECE_BYTES + 1:  # a text longer than a piece: its powers are not kept
            powers = (_powers(_BASE, size), _powers(_INVERSE, size))
        else:
            powers = _POWERS.setdefault(size, (_powers(_BASE, size), _powers(_INVERSE, size)))
    else:
        powers = _POWERS[size]
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE_VALUE[data] * powers[0][: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * powers[1][starts] + (ends - starts).astype(np.uint64))


def ngram_hashes(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `width` words in a row, and the position of the first word of each."""
    if len(words) < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    count = len(words) - width + 1
    out = words[:count] * _SHINGLE_FACTORS[0]
    for k in range(1, width):
        out = out + words[k : k + count] * _SHINGLE_FACTORS[k]
    at = np.flatnonzero(rows[:count] == rows[width - 1 :])
    return mix(out[at]), at


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct `width`-word shingles of each row: (rows, hashes), sorted by both.

    A-Z count as a-z. A row of fewer words has its whole sequence as its one shingle; a row without words has none.
    """
    data = LOWER[data]
    starts, ends, rows = runs(~SPACES[data], offsets)
    words = span_hashes(data, starts, ends)
    hashes, at = ngram_hashes(words, rows, width)
    owners = rows[at]
    count = np.bincount(rows, minlength=len(offsets) - 1)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        first = np.searchsorted(rows, short)
        whole = np.full(len(short), 0, np.uint64)
        for k in range(width - 1):
            has = count[short] > k
            whole[has] += words[first[has] + k] * _SHINGLE_FACTORS[k]
        owners = np.concatenate([owners, short])
        hashes = np.concatenate([hashes, mix(whole + count[short].astype(np.uint64))])
    order = np.lexsort((hashes, owners))
    owners, hashes = owners[order], hashes[order]
    if len(owners):
        new = np.empty(len(owners), bool)
        new[0] = True
        new[1:] = (owners[1:] != owners[:-1]) | (hashes[1:] != hashes[:-1])
        owners, hashes = owners[new], hashes[new]
    return owners, hashes
