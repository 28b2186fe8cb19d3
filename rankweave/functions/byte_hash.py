"""Murmur3-family hashes of whole byte strings, over Arrow buffers.

Spark's own `hash`/`xxhash64` use other seeds and tail rules, so these exist where stored hash values must match. A
column's bytes are read where they lie: one numpy step handles the same 4/8/16-byte block of all strings in a batch, as
long as many strings still have one. The few longest go on alone: their blocks are scrambled all at once, and only the
short recurrence between blocks runs one by one, some ten times slower for a byte than many short strings together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Constants of the hash family.
C1_32, C2_32 = 0xCC9E2D51, 0x1B873593
STEP_32 = (5, 0xE6546B64)
FINAL_32 = (0x85EBCA6B, 0xC2B2AE35)
C1_64, C2_64 = 0x87C37B91114253D5, 0x4CF5AD432745937F
STEP_64 = (5, 0x52DCE729, 0x38495AB5)
FINAL_64 = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


#: With fewer strings than this, a numpy step costs more than handling them one by one.
_FEW = 24


class _Batch:
    """Byte strings in one buffer, longest first, so that those with a block left are always a prefix."""

    def __init__(self, column: pa.Array, block: int):
        column = column.cast(pa.large_binary())
        size = len(column)
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64, size + 1, column.offset * 8) if size else np.zeros(1, np.int64)
        used = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if size and data is not None else np.empty(0, np.uint8)
        # Room to read whole blocks at the end.
        self.buffer = np.concatenate([used, np.zeros(16, np.uint8)])
        lengths = np.diff(offsets)
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths, self.starts = lengths[self.order], (offsets[:-1] - offsets[0])[self.order]
        self.block, self.blocks = block, self.lengths // block

    def steps(self):
        """(block number, how many strings still have a full block), as long as these are many."""
        most = int(self.blocks[0]) if len(self.blocks) else 0
        step = 0
        while step < most:
            live = int(np.searchsorted(-self.blocks, -(step + 1), side="right"))
            if live < _FEW:
                break
            yield step, live
            step += 1
        self.done = step

    def words(self, step: int, live: int, offset: int, dtype: str) -> np.ndarray:
        """The numbers of `dtype` at a place of the block, for the first `live` strings."""
        at = self.starts[:live] + (step * self.block + offset)
        width = np.dtype(dtype).itemsize
        every = np.ndarray((len(self.buffer) - width + 1,), dtype, self.buffer, strides=(1,))
        return every[at]

    def rest(self):
        """(string, its blocks that `steps` has not handled, as bytes) of the few longest."""
        for k in range(int(np.searchsorted(-self.blocks, -(self.done + 1), side="right"))):
            yield k, self.buffer[self.starts[k] + self.done * self.block : self.starts[k] + self.blocks[k] * self.block]

    def tail(self, offset: int, width: int, signed: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(little-endian number of the left-over bytes [offset, offset+width), which strings have any)"""
        left = self.lengths - self.blocks * self.block - offset
        base = self.starts + self.blocks * self.block + offset
        total = np.zeros(len(left), dtype=np.uint64)
        for i in range(width):
            byte = self.buffer[np.minimum(base + i, len(self.buffer) - 1)]
            value = byte.astype(np.int8).astype(np.int64) if signed else byte.astype(np.int64)
            total ^= np.where(left > i, value << (8 * i), 0).astype(np.uint64)
        return total, left > 0

    def restore(self, values: np.ndarray) -> np.ndarray:
        out = np.empty_like(values)
        out[self.order] = values
        return out


def _rotate(x: np.ndarray, bits: int) -> np.ndarray:
    width = x.dtype.itemsize * 8
    kind = x.dtype.type
    return (x << kind(bits)) | (x >> kind(width - bits))


def _scramble(k: np.ndarray, first: int, bits: int, second: int) -> np.ndarray:
    kind = k.dtype.type
    return _rotate(k * kind(first), bits) * kind(second)


def _finish(h: np.ndarray, shifts: tuple[int, int, int], factors: tuple[int, int]) -> np.ndarray:
    kind = h.dtype.type
    for shift, factor in zip(shifts[:2], factors):
        h = (h ^ (h >> kind(shift))) * kind(factor)
    return h ^ (h >> kind(shifts[2]))


def _finish_64(h: np.ndarray) -> np.ndarray:
    return _finish(h, (33, 33, 33), FINAL_64)


def _chain(h: int, words: np.ndarray, bits: int, add: int, width: int) -> int:
    """The recurrence over scrambled blocks of one string: mix in, rotate, times five, add."""
    mask, back = (1 << width) - 1, width - bits
    for k in words.tolist():
        h ^= k
        h = (((h << bits) | (h >> back)) * 5 + add) & mask
    return h


def _chain_pair(h1: int, h2: int, low: np.ndarray, high: np.ndarray, add1: int, add2: int) -> tuple[int, int]:
    """The same for two interlocked halves of 64 bits."""
    mask = (1 << 64) - 1
    for a, b in zip(low.tolist(), high.tolist(), strict=True):
        h1 ^= a
        h1 = ((((h1 << 27) | (h1 >> 37)) & mask) + h2) * 5 + add1 & mask
        h2 ^= b
        h2 = ((((h2 << 31) | (h2 >> 33)) & mask) + h1) * 5 + add2 & mask
    return h1, h2


def murmur32(column: pa.Array, seed: int) -> np.ndarray:
    batch = _Batch(column, 4)
    h = np.full(len(column), seed & 0xFFFFFFFF, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for step, live in batch.steps():
            k = _scramble(batch.words(step, live, 0, "<u4"), C1_32, 15, C2_32)
            h[:live] = _rotate(h[:live] ^ k, 13) * np.uint32(STEP_32[0]) + np.uint32(STEP_32[1])
        for at, left in batch.rest():
            h[at] = _chain(int(h[at]), _scramble(left.view("<u4"), C1_32, 15, C2_32), 13, STEP_32[1], 32)
        rest, some = batch.tail(0, 3, signed=True)
        k = _scramble((rest & np.uint64(0xFFFFFFFF)).astype(np.uint32), C1_32, 15, C2_32)
        h = np.where(some, h ^ k, h)
        h = _finish(h ^ batch.lengths.astype(np.uint32), (16, 13, 16), FINAL_32)
    return batch.restore(h).view(np.int32)


def murmur64(column: pa.Array, seed: int) -> np.ndarray:
    batch = _Batch(column, 8)
    h = np.full(len(column), seed, dtype=np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        for step, live in batch.steps():
            k = _scramble(batch.words(step, live, 0, "<u8"), C1_64, 31, C2_64)
            h[:live] = _rotate(h[:live] ^ k, 27) * np.uint64(STEP_64[0]) + np.uint64(STEP_64[1])
        for at, left in batch.rest():
            h[at] = _chain(int(h[at]), _scramble(left.view("<u8"), C1_64, 31, C2_64), 27, STEP_64[1], 64)
        rest, some = batch.tail(0, 7)
        h = np.where(some, h ^ _scramble(rest, C1_64, 31, C2_64), h)
        h = _finish_64(h ^ batch.lengths.astype(np.uint64))
    return batch.restore(h).view(np.int64)


def murmur128(column: pa.Array, seed: int) -> np.ndarray:
    batch = _Batch(column, 16)
    h1 = np.full(len(column), seed, dtype=np.int64).view(np.uint64)
    h2 = h1.copy()
    five, add1, add2 = (np.uint64(v) for v in STEP_64)
    with np.errstate(over="ignore"):
        for step, live in batch.steps():
            low = _scramble(batch.words(step, live, 0, "<u8"), C1_64, 31, C2_64)
            high = _scramble(batch.words(step, live, 8, "<u8"), C2_64, 33, C1_64)
            h1[:live] = (_rotate(h1[:live] ^ low, 27) + h2[:live]) * five + add1
            h2[:live] = (_rotate(h2[:live] ^ high, 31) + h1[:live]) * five + add2
        for at, left in batch.rest():
            words = left.view("<u8")
            low, high = _scramble(words[::2], C1_64, 31, C2_64), _scramble(words[1::2], C2_64, 33, C1_64)
            h1[at], h2[at] = _chain_pair(int(h1[at]), int(h2[at]), low, high, *STEP_64[1:])
        rest, some = batch.tail(8, 7)
        h2 = np.where(some, h2 ^ _scramble(rest, C2_64, 33, C1_64), h2)
        rest, some = batch.tail(0, 8)
        h1 = np.where(some, h1 ^ _scramble(rest, C1_64, 31, C2_64), h1)
        length = batch.lengths.astype(np.uint64)
        h1, h2 = h1 ^ length, h2 ^ length
        h1 = h1 + h2
        h2 = h2 + h1
        h1, h2 = _finish_64(h1), _finish_64(h2)
        h1 = h1 + h2
        h2 = h2 + h1
    return np.stack([batch.restore(h1).view(np.int64), batch.restore(h2).view(np.int64)], axis=1)


_FUNCTIONS = {"hash32": (murmur32, "int"), "hash64": (murmur64, "bigint"), "hash128": (murmur128, "array<bigint>")}


def byte_hash(value: Column, algorithm: str = "hash64", seed: int = 0) -> Column:
    """hash32 (int), hash64 (bigint) or hash128 (array of two bigints) of a string's UTF-8 bytes; null stays null."""
    function, data_type = _FUNCTIONS[algorithm]

    @F.arrow_udf(data_type)
    def hashed(column: pa.Array) -> pa.Array:
        there = column.is_valid()
        found = function(column.drop_null(), seed)
        if found.ndim == 2:
            found = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), 2).cast(pa.list_(pa.int64()))
        else:
            found = pa.array(found)
        # Each value back to its place; a null has none.
        place = pc.subtract(pc.cumulative_sum(there.cast(pa.int64())), 1)
        return found.take(pc.if_else(there, place, pa.scalar(None, pa.int64())))

    return hashed(value)
