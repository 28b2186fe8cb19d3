"""Names for lists of ids: each chunk of lists asks once for what its lists hold, however often they hold it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rankweave.session import cut_lineage

#: Ids of one block of the dictionary.
BLOCK_IDS = 65_536

#: Lists of one chunk at most.
CHUNK_LISTS = 8_192

#: Chunks whose questions to one block are answered together.
SHARE_CHUNKS = 64


def name_lists(lists: DataFrame, names: DataFrame, key: str, ids: str = "ids", *, id: str = "id", name: str = "name") -> DataFrame:
    """`lists` (`key`, `ids` array, further columns) with `names`, the name of each id in its place; an id that the
    dictionary `names` (`id`, `name`) does not have gets null.

    A join by id would gather all occurrences of a popular id in one task. Here lists are packed into chunks; a chunk asks
    each block of the dictionary once for the ids that its lists hold, and names come back to their places. Questions to a
    block are answered in shares of some chunks, each with its copy of the block. Chunks are written to the shared
    checkpoint folder. Null lists stay null; null ids have no name; repeated dictionary ids count once (the smallest name).
    """
    schema = lists.schema
    columns = schema.names
    if "names" in columns or key not in columns or ids not in columns:
        raise ValueError(f"lists need {key!r} and {ids!r}, and no column 'names', not {columns}")
    kinds = {f.name: to_arrow_type(f.dataType) for f in schema}
    name_kind = to_arrow_type(names.schema[name].dataType)
    name_type = names.schema[name].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, CHUNK_LISTS):
                part = batch.slice(first, CHUNK_LISTS)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as writer:
                    writer.write_batch(part)
                held = part.column(ids).flatten().drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.record_batch([pa.array([number]), pa.array([np.unique(held).tobytes()], pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "wanted", "lists"])
                number += 1

    chunks = cut_lineage(lists.mapInArrow(pack, "chunk long, wanted binary, lists binary"))
    shares = max(1, -(-chunks.count() // SHARE_CHUNKS))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, wanted in zip(batch.column("chunk").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                wanted = np.frombuffer(wanted, np.int64)
                block = wanted // BLOCK_IDS
                heads = np.flatnonzero(np.diff(block, prepend=block[:1] - 1))
                packed = [wanted[a:b].tobytes() for a, b in zip(heads, np.append(heads, len(wanted))[1:], strict=True)]
                yield pa.record_batch([pa.array(block[heads]), pa.array([chunk] * len(heads), pa.int64()), pa.array(packed, pa.binary())], names=["block", "chunk", "wanted"])

    share = F.pmod(F.xxhash64("chunk"), F.lit(shares)).cast("int")
    asks = chunks.select("chunk", "wanted").mapInArrow(ask, "block long, chunk long, wanted binary").withColumn("share", share)
    known = names.where(F.col(id).isNotNull()).groupBy(F.col(id).cast("long").alias("id")).agg(F.min(name).alias("name"))
    held = known.select(F.floor(F.col("id") / BLOCK_IDS).alias("block"), "id", "name").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))

    def answer(asked: pa.Table, held: pa.Table) -> pa.Table:
        own = held["id"].to_numpy()
        order = np.argsort(own)
        own, given = own[order], held["name"].combine_chunks().take(pa.array(order))
        found, chunk, counts = [], asked["chunk"].to_pylist(), []
        for wanted in asked["wanted"].to_pylist():
            wanted = np.frombuffer(wanted, np.int64)
            at = np.searchsorted(own, wanted)
            hit = at < len(own)
            hit[hit] = own[at[hit]] == wanted[hit]
            found.append((wanted[hit], given.take(pa.array(at[hit]))))
            counts.append(int(hit.sum()))
        every = pa.concat_arrays([pa.array([], name_kind), *(n for _, n in found)])
        cuts = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
        return pa.table([pa.array(chunk, pa.int64()), pa.array([i.tobytes() for i, _ in found], pa.binary()), pa.ListArray.from_arrays(cuts, every)], names=["chunk", "known", "given"])

    by = ["block", "share"]
    answers = asks.groupBy(*by).cogroup(held.groupBy(*by)).applyInArrow(answer, f"chunk long, known binary, given array<{name_type}>")

    def place(packed: pa.Table, answered: pa.Table) -> pa.Table:
        if not packed.num_rows:
            return pa.table([pa.array([], kinds[c]) for c in columns] + [pa.array([], pa.list_(name_kind))], names=[*columns, "names"])
        rows = pa.ipc.open_stream(packed["lists"][0].as_py()).read_all().combine_chunks()
        own = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(k, np.int64) for k in answered["known"].to_pylist())])
        given = pa.concat_arrays([pa.array([], name_kind), *(g.values for g in answered["given"])])
        order = np.argsort(own)
        own = own[order]
        column = rows[ids].combine_chunks()
        flat = column.flatten()
        wanted = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.minimum(np.searchsorted(own, wanted), max(len(own) - 1, 0))
        hit = (own[at] == wanted if len(own) else np.zeros(len(wanted), bool)) & flat.is_valid().to_numpy(zero_copy_only=False)
        spot = pa.array(np.where(hit, order[at] if len(own) else 0, 0), mask=~hit)
        lengths = column.value_lengths().fill_null(0).to_numpy()
        cuts = np.append(0, np.cumsum(lengths)).astype(np.int32)
        # A null offset makes a null list.
        named = pa.ListArray.from_arrays(pa.array(cuts, mask=np.append(column.is_null().to_numpy(zero_copy_only=False), False)), given.take(spot))
        return pa.table([rows[c] for c in columns] + [named], names=[*columns, "names"])

    output = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + f", names array<{name_type}>"
    return chunks.select("chunk", "lists").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(place, output)
