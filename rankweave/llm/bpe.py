"""Byte-level BPE over a corpus: each distinct word is encoded once, and its ids go back to every place of the word."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.text import frugal, give_back

#: Text bytes in one chunk, the unit in which documents wait for the ids of their words.
CHUNK_BYTES = 8 << 20
#: Words in one batch of results.
BATCH_WORDS = 100_000
#: Ids decoded at a time.
BATCH_IDS = 300_000

#: Fixed value: the word pattern of the byte-level vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class is the same in all Unicode versions at hand. Other texts are split by the tokenizer itself.
_SETTLED = regex.compile(r"[\u0000-\u0557\u2010-\u205e\u3000-\u9fef\uac00-\ud7a3]*")


def read_vocabulary(path: str) -> str:
    """The tokenizer file's text. It is sent to the tasks, so executors do not need the file."""
    return Path(path).read_text(encoding="utf-8")


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, as a rule: printing Latin-1
    characters stand for themselves, the others in order for 256 and up."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Splitter:
    """Splits a text into the words that the tokenizer would encode one by one."""

    def __init__(self, vocabulary: str):
        names = sorted((t["content"] for t in json.loads(vocabulary).get("added_tokens", [])), key=lambda t: (-len(t), t))
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.names = names
        self.words = regex.compile(WORDS)
        self.vocabulary, self.bytes, self.tokenizer = vocabulary, _byte_characters(), None

    def _ordinary(self, text: str) -> list[str]:
        if _SETTLED.fullmatch(text):
            return self.words.findall(text)
        self.tokenizer = self.tokenizer or _tokenizer(self.vocabulary)
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(self.bytes[c] for c in word).decode("utf-8") for word, _ in found]

    def split(self, text: str) -> list[str]:
        if self.special is None or not any(name in text for name in self.names):
            return self._ordinary(text)
        out = []
        for k, part in enumerate(self.special.split(text)):
            out += [part] if k % 2 else self._ordinary(part)
        return out


def _tokenizer(vocabulary: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
    found = Tokenizer.from_str(vocabulary)
    found.no_truncation()
    found.no_padding()
    return found


def _squeeze(values: bytes) -> bytes:
    return len(values).to_bytes(8, "little") + pa.compress(values, codec="zstd", asbytes=True)


def _restore(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def _planes(numbers: np.ndarray) -> bytes:
    """The numbers' first bytes, then all second ones and so on: this packs a third smaller."""
    return numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _join(words: list[str]) -> tuple[bytes, bytes]:
    encoded = [w.encode() for w in words]
    return _squeeze(np.array([len(w) for w in encoded], np.int32).tobytes()), _squeeze(b"".join(encoded))


def _unjoin(lengths: bytes, body: bytes) -> list[bytes]:
    ends = np.cumsum(np.frombuffer(_restore(lengths), np.int32)).tolist()
    body = _restore(body)
    return [body[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def encode(docs: DataFrame, vocabulary: str, *, id: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """(`id`, ids array<int>) for every row: the token ids of its whole text; none for a null or empty text.

    The same as the tokenizers library gives without special tokens added, truncation or padding; a special token's
    string inside a text is that token. Each row is encoded by itself, so equal ids and repeated rows stay as they are.

    1. A task cuts its documents into chunks of about CHUNK_BYTES of text and writes each as numbers into the chunk's
       list of distinct words. Chunks are shuffled once, compressed, by their key; both steps below read that shuffle.
    2. Each chunk's words go to `buckets` (default: the shuffle partitions) by their crc32. A task keeps the words of
       its buckets and encodes each distinct one once in the whole corpus.
    3. The ids come back by chunk and bucket and are put in place by position.

    A word that is in every document is sent once for each chunk, so frequent words weigh no more than others. A chunk's
    key comes from its place and content; if a lost task is rerun on rows in another order, a chunk may find no ids, and
    then encodes its own words.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shipped = spark.sparkContext.broadcast(vocabulary)
    thin = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = dict(thin.dtypes)["id"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(shipped.value)
        place = TaskContext.get().partitionId()
        number, size, ids, counts, numbers = 0, 0, [], [], []
        known: dict[str, int] = {}

        def chunk():
            digest = xxhash.xxh64(f"{place} {number}")
            index = np.concatenate(numbers) if numbers else np.empty(0, np.int32)
            digest.update(index.tobytes())
            digest.update("\0".join(known))
            lengths, body = _join(list(known))
            key = digest.intdigest() - (1 << 63)
            values = [[key], pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()), pa.concat_arrays(ids)), [counts], [_squeeze(_planes(index))], [lengths], [body]]
            return pa.record_batch(
                [pa.array(v, t) if isinstance(v, list) else v for v, t in zip(values, [pa.int64(), None, pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()], strict=True)],
                names=["chunk", "ids", "counts", "numbers", "lengths", "words"],
            )

        for batch in batches:
            for row, value in enumerate(batch.column("text")):
                value = value.as_py()
                words = splitter.split(value)
                index = [known.setdefault(w, len(known)) for w in words]
                ids.append(batch.column("id").slice(row, 1))
                counts.append(len(words))
                numbers.append(np.array(index, np.int32))
                size += len(value.encode())
                if size >= CHUNK_BYTES:
                    yield chunk()
                    number, size, ids, counts, numbers, known = number + 1, 0, [], [], [], {}
        if ids:
            yield chunk()

    chunks = thin.mapInArrow(frugal(pack), f"chunk long, ids array<{kind}>, counts array<int>, numbers binary, lengths binary, words binary").repartition("chunk")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, lengths, body in zip(*(batch.column(c).to_pylist() for c in ("chunk", "lengths", "words")), strict=True):
                sorted_out: dict[int, list[bytes]] = {}
                for word in _unjoin(lengths, body):
                    sorted_out.setdefault(crc32(word) % buckets, []).append(word)
                packed = [(_squeeze(np.array([len(w) for w in words], np.int32).tobytes()), _squeeze(b"".join(words))) for words in sorted_out.values()]
                yield pa.record_batch(
                    [pa.array(list(sorted_out), pa.int32()), pa.array([key] * len(packed), pa.int64()), pa.array([p[0] for p in packed], pa.binary()), pa.array([p[1] for p in packed], pa.binary())],
                    names=["bucket", "chunk", "lengths", "words"],
                )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, known, last = _tokenizer(shipped.value), {}, None
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for bucket, key, lengths, body in zip(*(batch.column(c).to_pylist() for c in ("bucket", "chunk", "lengths", "words")), strict=True):
                words = _unjoin(lengths, body)
                if bucket != last:  # rows are sorted by bucket, and no word is in two
                    known, last = {}, bucket
                _learn(tokenizer, known, words)
                found = [known[w] for w in words]
                for column, value in zip(out, (key, bucket, _squeeze(np.array([len(f) for f in found], np.int32).tobytes()), _squeeze(b"".join(f.tobytes() for f in found))), strict=True):
                    column.append(value)
            yield pa.record_batch([pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["chunk", "bucket", "sizes", "tokens"])

    # All columns, as the cogroup below: a narrower projection would move under the shuffle and make it a second one.
    asked = chunks.mapInArrow(frugal(ask), "bucket int, chunk long, lengths binary, words binary")
    answers = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(frugal(answer), "chunk long, bucket int, sizes binary, tokens binary")

    def place_back(left: Iterator[pa.RecordBatch], right: pa.Table) -> Iterator[pa.RecordBatch]:
        order = np.argsort(right.column("bucket").to_numpy(), kind="stable") if right.num_rows else []
        packed = {c: right.column(c).to_pylist() for c in ("bucket", "sizes", "tokens")}
        for row in left:
            words = _unjoin(row["lengths"], row["words"])
            bucket = np.fromiter((crc32(w) % buckets for w in words), np.int32, len(words))
            here = np.argsort(bucket, kind="stable")
            sizes = np.concatenate([np.frombuffer(_restore(packed["sizes"][i]), np.int32) for i in order] or [np.empty(0, np.int32)])
            tokens = np.concatenate([np.frombuffer(_restore(packed["tokens"][i]), np.int32) for i in order] or [np.empty(0, np.int32)])
            if len(sizes) != len(words):
                known: dict[bytes, np.ndarray] = {}
                _learn(_tokenizer(shipped.value), known, words)
                found = [known[words[i]] for i in here]
                sizes = np.array([len(f) for f in found], np.int32)
                tokens = np.concatenate(found or [np.empty(0, np.int32)])
            size, start = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
            size[here], start[here] = sizes, np.cumsum(sizes) - sizes
            numbers = _from_planes(_restore(row["numbers"]))
            ends = np.cumsum(row["counts"], dtype=np.int64)
            first = 0
            while first < len(ends):
                begin = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, begin + BATCH_WORDS, "right")))
                at = numbers[begin : ends[last - 1]]
                total = np.concatenate([[0], np.cumsum(size[at])])
                places = np.arange(total[-1]) - np.repeat(total[:-1] - start[at], size[at])
                bounds = total[np.concatenate([[0], ends[first:last] - begin])].astype(np.int32)
                yield pa.record_batch([row["ids"].slice(first, last - first), pa.ListArray.from_arrays(pa.array(bounds), pa.array(tokens[places]))], names=["id", "ids"])
                first = last

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        rows = []
        for k in range(left.num_rows):
            row = {c: left.column(c)[k].as_py() for c in ("counts", "numbers", "lengths", "words")}
            rows.append(row | {"ids": left.column("ids")[k].values})
        made = list(place_back(rows, right))
        return pa.Table.from_batches(made) if made else pa.table({"id": left.column("ids").combine_chunks().flatten()[:0], "ids": pa.array([], pa.list_(pa.int32()))})

    placed = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(group, f"id {kind}, ids array<int>")
    return placed.withColumnRenamed("id", id)


def _learn(tokenizer, known: dict[bytes, np.ndarray], words: list[bytes]) -> None:
    """Add the ids of the words that are not known yet."""
    new = list(dict.fromkeys(w for w in words if w not in known))
    for first in range(0, len(new), 10_000):
        part = new[first : first + 10_000]
        for word, found in zip(part, tokenizer.encode_batch([w.decode() for w in part], add_special_tokens=False), strict=True):
            known[word] = np.array(found.ids, np.int32)


def _pieces(vocabulary: str) -> list[bytes]:
    """The bytes of each id's piece, and an empty one at the end for unknown ids."""
    content, characters = json.loads(vocabulary), _byte_characters()
    names = content["model"]["vocab"] | {t["content"]: t["id"] for t in content.get("added_tokens", [])}
    table = [b""] * (max(names.values(), default=-1) + 2)
    for name, number in names.items():
        table[number] = b"".join(bytes([characters[c]]) if c in characters else c.encode() for c in name)
    return table


def decode(encoded: DataFrame, vocabulary: str, *, id: str = "doc_id", ids: str = "ids", text: str = "text") -> DataFrame:
    """(`id`, `ids`, `text`) for every row of token ids: the pieces of the ids, joined by position, as a text.

    The id-to-piece table is as large as the vocabulary. Ids that it lacks give nothing; bytes that are no UTF-8 give the
    replacement character. Null ids give an empty text.
    """
    shipped = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    thin = encoded.select(F.col(id).alias("id"), F.col(ids).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(_pieces(shipped.value), pa.large_binary())
        for batch in batches:
            bounds = np.concatenate([[0], np.cumsum(batch.column("ids").value_lengths().fill_null(0).to_numpy())])
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + BATCH_IDS, "right")) - 1)
                numbers = batch.column("ids").slice(first, last - first)
                wanted = numbers.flatten().fill_null(-1).to_numpy()
                wanted = np.where((wanted < 0) | (wanted >= len(pieces) - 1), len(pieces) - 1, wanted)
                joined = pieces.take(pa.array(wanted, pa.int64()))
                offsets = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1) if len(joined) else np.zeros(1, np.int64)
                body = memoryview(joined.buffers()[2] or b"")
                cuts = offsets[bounds[first : last + 1] - bounds[first]]
                texts = [bytes(body[a:b]).decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.record_batch([batch.column("id").slice(first, last - first), numbers, pa.array(texts, pa.string())], names=["id", "ids", "text"])
                first = last

    found = thin.mapInArrow(frugal(run), f"id {dict(thin.dtypes)['id']}, ids array<int>, text string")
    return found.select(F.col("id").alias(id), F.col("ids").alias(ids), F.col("text").alias(text))
