"""What the trained operators share: the fold rule, bounded labelled samples, and a single bounded training task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose id hashes to this remainder are never trained on.
FOLDS, HELD_OUT = 5, 0


def held_out(id: str | Column) -> Column:
    """True if crc32 of the id as text leaves the held-out remainder. A null id counts as the empty text: held out."""
    id = F.col(id) if isinstance(id, str) else id
    return (F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % FOLDS) == HELD_OUT


#: How many times the wanted rows a hash bound lets through, so that it hardly ever lets through too few.
_SLACK = 4


def hash_below(key: Column, share: Column | float) -> Column:
    """True for about `share` of all keys, by a hash of the key."""
    bound = F.lit(share) if isinstance(share, (int, float)) else share
    return F.xxhash64(key) / F.lit(2.0**64) + 0.5 <= bound


def first_by_hash(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """At most `limit` rows, the first by a hash of `key`, ties by the key.

    Sorting all rows for their first few lets each task keep `limit` of them and gathers these in one task. So rows are
    counted first, and only those with a hash below a bound that lets some times `limit` through are sorted; if too few
    come through (keys repeat very often), all are.
    """
    share = _SLACK * limit / max(rows.count(), 1)
    if share < 1:
        thin = rows.where(hash_below(F.col(key), share))
        if thin.count() >= limit:
            rows = thin
    return rows.orderBy(F.xxhash64(key), key).limit(limit)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, label 0/1) of at most `rows` labelled documents outside the held-out fold, the first by a hash of the id.

    Only ids and labels are ordered; the at most `rows` chosen ones are broadcast to the scan of the texts. Null labels
    are left out; an id with several labels takes the largest.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull() & ~held_out(id))
    known = known.groupBy(F.col(id).alias("_id")).agg(F.max(F.col(label)).cast("int").alias("label"))
    chosen = first_by_hash(known, "_id", rows)
    texts = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Rows that repeat an id must not enlarge the sample: one text stays, the smallest.
    return texts.join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
