"""Fill-in-the-middle rearrangement: texts cut at two code points, found in a compressed set of code point boundaries."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm.text import pieces

#: Places that one container covers.
CHUNK = 1 << 16
_WORDS = CHUNK // 64


class Settings(NamedTuple):
    """Markers before prefix, suffix and middle; how many of 100 texts stay plain, and of 100 others put the suffix first."""

    seed: str = "1"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    plain: int = 10
    suffix_first: int = 20


class Boundaries:
    """The byte places at which code points start, in containers of 65,536 places.

    A container is the smallest of three: the places themselves, a bitmap with the number of set bits before each
    64-bit word, or the runs of neighbouring places with the number of places before each run. `before` has the
    number of places before each container.
    """

    def __init__(self, starts: np.ndarray):
        """`starts` has one boolean for each byte."""
        self.size = len(starts)
        self.containers = [self._container(starts[k : k + CHUNK]) for k in range(0, len(starts), CHUNK)]
        self.before = np.cumsum([0, *(count for _, count, *_ in self.containers)])

    @staticmethod
    def _container(flags: np.ndarray) -> tuple:
        count = int(np.count_nonzero(flags))
        turns = np.flatnonzero(flags[1:] != flags[:-1]) + 1
        if flags[0]:
            turns = np.append(0, turns)
        runs = (len(turns) + 1) // 2
        cost = {"array": 2 * count, "bitmap": CHUNK // 8, "run": 4 * runs}
        kind = min(cost, key=cost.get)
        if kind == "run":
            first = turns[::2]
            length = np.append(turns[1::2], len(flags))[:runs] - first
            return kind, count, first.astype(np.uint16), np.cumsum(length) - length
        if kind == "array":
            return kind, count, np.flatnonzero(flags).astype(np.uint16)
        bits = np.zeros(CHUNK, bool)
        bits[: len(flags)] = flags
        words = np.packbits(bits, bitorder="little").view("<u8")
        each = np.bitwise_count(words).astype(np.int64)
        return kind, count, words, np.cumsum(each) - each

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The byte at which code point `k` (from 0) starts; the end of the text for its number of code points."""
        if k >= len(self):
            return self.size
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return at * CHUNK + self._local(self.containers[at], k - int(self.before[at]))

    @staticmethod
    def _local(container: tuple, k: int) -> int:
        kind, _, values, *rest = container
        if kind == "array":
            return int(values[k])
        at = int(np.searchsorted(rest[0], k, "right")) - 1
        k -= int(rest[0][at])
        if kind == "run":
            return int(values[at]) + k
        word = int(values[at])
        for _ in range(k):
            word &= word - 1  # drop the lowest bit
        return at * 64 + (word & -word).bit_length() - 1


_CUTS = pa.struct([("n", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("first_byte", pa.int32()), ("last_byte", pa.int32())])


def cuts(text: Column, one: Column, two: Column) -> Column:
    """struct(n, first, last, first_byte, last_byte): the code points of `text`, and its cuts at `one` and `two` modulo
    n + 1, the smaller first, in code points and in bytes. A null text is empty."""

    @F.arrow_udf("n long, first long, last long, first_byte int, last_byte int")
    def run(texts: pa.Array, ones: pa.Array, twos: pa.Array) -> pa.Array:
        out = np.empty((5, len(texts)), np.int64)
        wanted = np.stack([ones.to_numpy(zero_copy_only=False), twos.to_numpy(zero_copy_only=False)])
        for first, last, data, offsets in pieces(texts):
            starts = (data & 0xC0) != 0x80
            for row in range(first, last):
                places = Boundaries(starts[offsets[row - first] : offsets[row - first + 1]])
                n = len(places)
                a, b = sorted(int(x) % (n + 1) for x in wanted[:, row])
                out[:, row] = n, a, b, places.select(a), places.select(b)
        return pa.StructArray.from_arrays([pa.array(x).cast(f.type) for x, f in zip(out, _CUTS, strict=True)], fields=list(_CUTS))

    return run(text, one, two)


def fill_in_middle(docs: DataFrame, settings: Settings = Settings(), *, id: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Every text as `id`, n (code points), form, prefix_chars, middle_chars (null if plain), output, and `keep` columns.

    The id's digest (sha256 of seed, a colon and the decimal id) gives four numbers of 32 bits: two cuts, modulo n + 1;
    whether the text stays plain; whether the suffix comes first. `psm` is prefix, suffix, middle behind their markers,
    `spm` suffix, prefix, middle. Texts that are empty or hold a marker stay plain.

    Each text goes to a Python worker once; only its cuts come back, and the JVM puts the bytes together. Nothing is
    shuffled. A null text is empty, a null id has the digest of the empty text behind the colon. Rows with equal ids stay
    apart and are cut by the same numbers. Other columns are not read.
    """
    s = settings
    digest = F.sha2(F.concat(F.lit(f"{s.seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))).cast("binary"), 256)
    number = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"_h{k}") for k in range(4)]
    rows = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"), *number, F.struct(*keep).alias("_kept") if keep else F.lit(None).cast("string").alias("_kept"))
    rows = rows.withColumn("_cut", cuts(F.col("_text"), F.col("_h0"), F.col("_h1")))
    marked = F.lit(False)
    for mark in (s.prefix, s.suffix, s.middle):
        marked = marked | F.contains("_text", F.lit(mark))
    plain = (F.col("_text") == "") | marked | (F.col("_h2") % 100 >= 100 - s.plain)
    rows = rows.withColumn("form", F.when(plain, "plain").when(F.col("_h3") % 100 < s.suffix_first, "spm").otherwise("psm"))

    def part(start: str, end: str) -> Column:
        return F.expr(f"CAST(substring(CAST(_text AS BINARY), {start} + 1, {end} - {start}) AS STRING)")

    first, last, end = "_cut.first_byte", "_cut.last_byte", "octet_length(_text)"
    prefix = [F.lit(s.prefix), part("0", first)]
    suffix = [F.lit(s.suffix), part(last, end)]
    middle = [F.lit(s.middle), part(first, last)]
    output = F.when(F.col("form") == "plain", F.col("_text")).when(F.col("form") == "psm", F.concat(*prefix, *suffix, *middle)).otherwise(F.concat(*suffix, *prefix, *middle))
    cut_up = F.col("form") != "plain"
    return rows.select(
        F.col("_id").alias(id),
        F.col("_cut.n").alias("n"),
        "form",
        F.when(cut_up, F.col("_cut.first")).alias("prefix_chars"),
        F.when(cut_up, F.col("_cut.last") - F.col("_cut.first")).alias("middle_chars"),
        output.alias("output"),
        *[F.col("_kept")[c].alias(c) for c in keep],
    )


def restore(output: str | Column, form: str | Column, settings: Settings = Settings()) -> Column:
    """The text that `fill_in_middle` turned into `output`. A marker cannot arise across a cut, as none ends with its first
    byte or holds it twice, so the first one found is the one put in."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    s = settings

    def between(a: str, b: str | None) -> Column:
        rest = F.substring_index(output, a, -1)
        return F.substring_index(rest, b, 1) if b else rest

    psm = F.concat(between(s.prefix, s.suffix), between(s.middle, None), between(s.suffix, s.middle))
    spm = F.concat(between(s.prefix, s.middle), between(s.middle, None), between(s.suffix, s.prefix))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
