"""Word spans in byte buffers, and their digests by published functions: CRC-32 and XXH64, whole columns at a time."""

from __future__ import annotations

import zlib

import numpy as np

from rankweave.llm.text import LOWER

#: Beyond this many bytes a span is digested on its own.
LONG_SPAN = 64


def joined_words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, starts, ends, rows): the words of each row, A-Z as a-z, each followed by one space in one buffer.

    Words are the maximal runs of bytes that `word_bytes` marks after lower-casing. So `width` words in a row, joined by
    one space, are one span of the buffer, from the first one's start to the last one's end.
    """
    data = np.insert(LOWER[data], offsets[1:], 0x20)  # a row's last word must not touch the next row's first
    inside = word_bytes[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    ends_of_rows = np.cumsum(keep)[offsets[1:] + np.arange(len(offsets) - 1)] if len(offsets) > 1 else np.empty(0, np.int64)
    buffer = np.where(inside, data, np.uint8(0x20))[keep]
    ends = np.flatnonzero(~inside[keep])
    starts = np.empty_like(ends)
    starts[:1] = 0
    starts[1:] = ends[:-1] + 1
    return buffer, starts, ends, np.searchsorted(ends_of_rows, starts, "right")


def word_runs(starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, rows) of all runs of `width` words within a row."""
    if len(starts) < width:
        return starts[:0], ends[:0], rows[:0]
    count = len(starts) - width + 1
    at = np.flatnonzero(rows[:count] == rows[width - 1 :])
    return starts[at], ends[at + width - 1], rows[at]


#: The step of CRC-32 by its low byte: the digest of one byte b is ~(step[0xFF ^ b] ^ 0x00FFFFFF).
_CRC = np.array([zlib.crc32(bytes([0xFF ^ k])) ^ 0xFF000000 for k in range(256)], np.uint32)


def crc32(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The unsigned CRC-32 of each span."""
    length = ends - starts
    order = np.argsort(-np.minimum(length, LONG_SPAN + 1).astype(np.int8), kind="stable")
    at, size = starts[order], length[order]
    value = np.full(len(order), 0xFFFFFFFF, np.uint32)
    own = int(np.searchsorted(-size, -LONG_SPAN))  # the spans before are longer
    longer = np.searchsorted(-size, -np.arange(LONG_SPAN), "left")
    for k in range(int(size[own]) if own < len(size) else 0):
        part = slice(own, int(longer[k]))
        seen = value[part]
        value[part] = _CRC[(seen ^ buffer[at[part] + k]) & np.uint32(0xFF)] ^ (seen >> np.uint32(8))
    value = ~value
    for k in range(own):
        value[k] = zlib.crc32(buffer[at[k] : at[k] + size[k]])
    out = np.empty_like(value)
    out[order] = value
    return out


# Fixed values of the XXH64 specification: its five primes.
_P1 = np.uint64(0x9E3779B185EBCA87)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F)
_P3 = np.uint64(0x165667B19E3779F9)
_P4 = np.uint64(0x85EBCA77C2B2AE63)
_P5 = np.uint64(0x27D4EB2F165667C5)


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(lane: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _turn(lane + word * _P2, 31) * _P1


def xxh64(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """The unsigned XXH64 of each span."""
    if not len(starts):
        return np.empty(0, np.uint64)
    padded = np.concatenate([buffer, np.zeros(8, np.uint8)])
    # The eight bytes from every place on, as one little-endian number.
    word = np.ascontiguousarray(np.ndarray((len(buffer) + 1,), "<u8", padded, strides=(1,)))
    length = ends - starts
    with np.errstate(over="ignore"):
        base = np.uint64(seed)
        value = np.full(len(starts), base + _P5, np.uint64)
        wide = np.flatnonzero(length >= 32)
        if len(wide):
            wide = wide[np.argsort(-length[wide], kind="stable")]
            stripes, at = length[wide] // 32, starts[wide]
            lanes = [np.full(len(wide), base + x, np.uint64) for x in (_P1 + _P2, _P2, np.uint64(0), np.uint64(0) - _P1)]
            for k in range(int(stripes[0])):
                now = int(np.searchsorted(-stripes, -k, "left"))
                for j, lane in enumerate(lanes):
                    lane[:now] = _round(lane[:now], word[at[:now] + (32 * k + 8 * j)])
            merged = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
            for lane in lanes:
                merged = (merged ^ _round(np.uint64(0), lane)) * _P1 + _P4
            value[wide] = merged
        value += length.astype(np.uint64)
        left, at = length & 31, starts + (length & ~31)
        for k in range(3):
            now = np.flatnonzero(left >= 8 * (k + 1))
            value[now] = _turn(value[now] ^ _round(np.uint64(0), word[at[now] + 8 * k]), 27) * _P1 + _P4
        now = np.flatnonzero(left & 4)
        value[now] = _turn(value[now] ^ (word[at[now] + (left[now] & ~7)] & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
        for k in range(3):
            now = np.flatnonzero((left & 3) > k)
            value[now] = _turn(value[now] ^ (word[at[now] + (left[now] & ~3) + k] & np.uint64(0xFF)) * _P5, 11) * _P1
        value = (value ^ (value >> np.uint64(33))) * _P2
        value = (value ^ (value >> np.uint64(29))) * _P3
        return value ^ (value >> np.uint64(32))
