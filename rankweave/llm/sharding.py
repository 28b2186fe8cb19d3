"""Contiguous shards of nearly equal bytes, by prefix sums over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankweave.session import cut_lineage

#: Bytes that a document takes besides its text.
ROW_BYTES = 8


def assign_shards(docs: DataFrame, shards: int = 24, *, id: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Deal all rows out to `shards` contiguous pieces of one global order, cut at equal byte targets.

    Rows are ordered by 4,096 hash ranges of the text and, within each, 256 hash ranges of the id, then by id. So equal
    texts stand in one narrow range and share a shard unless a cut falls there, while a text that a third of all rows
    hold is still spread over 256 groups. Each (text range, id range) group is summed; offsets of the groups come from
    two levels of totals, 256 in a range and 4,096 in all, so no window sees more than one group or those totals. A row
    belongs to the shard in whose share of the total its first byte falls: every shard is within one row of the target.

    A row's size is the UTF-8 bytes of its text (none for null) plus 8. Returns `id`, size, text_crc32 (of the empty
    text for null), shard, slot (gapless from 0 in each shard), and the `keep` columns. Null ids take part. Repeated
    rows are rows of their own; their order among each other is not defined and does not matter. Shards may be empty if
    there are fewer rows than shards. Other columns are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    name = F.coalesce(F.col(id).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id).alias("_id"),
        (F.octet_length(body).cast("long") + ROW_BYTES).alias("_size"),
        F.crc32(F.encode(body, "UTF-8")).alias("_crc"),
        F.conv(F.substring(F.md5(body), 1, 3), 16, 10).cast("int").alias("_range"),
        F.conv(F.substring(F.md5(name), 1, 2), 16, 10).cast("int").alias("_part"),
        F.struct(*keep).alias("_kept") if keep else F.lit(None).cast("string").alias("_kept"),
    )
    # The narrow rows are read three times below; the texts are read once.
    rows = cut_lineage(rows)

    group = ["_range", "_part"]
    in_group = W.partitionBy(*group).orderBy("_id", "_crc", "_size").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumns({"_b": F.coalesce(F.sum("_size").over(in_group), F.lit(0)), "_n": F.count("*").over(in_group)})
    sums = rows.groupBy(*group).agg(F.sum("_size").alias("_gb"), F.count("*").alias("_gn"))
    before = W.partitionBy("_range").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = sums.withColumns({"_pb": F.coalesce(F.sum("_gb").over(before), F.lit(0)), "_pn": F.coalesce(F.sum("_gn").over(before), F.lit(0))})
    ranges = sums.groupBy("_range").agg(F.sum("_gb").alias("_rb"), F.sum("_gn").alias("_rn"))
    # At most 4,096 rows from here on to the offsets.
    ahead = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy("_range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranges = ranges.select(
        "_range",
        F.coalesce(F.sum("_rb").over(ahead), F.lit(0)).alias("_ob"),
        F.coalesce(F.sum("_rn").over(ahead), F.lit(0)).alias("_on"),
        F.sum("_rb").over(everything).alias("_total"),
    )
    offsets = parts.join(F.broadcast(ranges), "_range").select(
        *group, (F.col("_pb") + F.col("_ob")).alias("_fb"), (F.col("_pn") + F.col("_on")).alias("_fn"), "_total"
    )
    dealt = placed.join(offsets, group).select(
        "_id", "_size", "_crc", "_kept", (F.col("_n") + F.col("_fn")).alias("_row"),
        F.least(F.lit(shards - 1).cast("long"), F.expr(f"(_b + _fb) * {shards} div _total")).cast("int").alias("_shard"),
    )
    firsts = dealt.groupBy("_shard").agg(F.min("_row").alias("_first"))  # one row for each shard
    return dealt.join(F.broadcast(firsts), "_shard").select(
        F.col("_id").alias(id),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.col("_shard").alias("shard"),
        (F.col("_row") - F.col("_first")).alias("slot"),
        *[F.col("_kept")[c].alias(c) for c in keep],
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24, *, id: str = "doc_id", text: str = "text") -> None:
    """Write all columns of `docs` as one folder per shard, each with as many files as its bytes ask for."""
    clash = {"size", "text_crc32", "shard", "slot"} & set(docs.columns)
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)}: the shards use these names")
    keep = [c for c in docs.columns if c != id]
    dealt = assign_shards(docs, shards, id=id, text=text, keep=keep)
    dealt.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
