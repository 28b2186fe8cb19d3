"""Column expressions for tag strings (`"tag:score,tag2:score,tag3"`), `key:value` scalars and braced tag maps.

All splits follow the Java rule that trailing empty parts are dropped, which `F.split` alone does not do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankweave.functions.binding import bind

#: Fill value of a missing tag string, and the word that marks "no tag".
MISSING_TAG = "null:0.0"
NULL_TERM = "null"


def split_parts(value: Column, separator: str) -> Column:
    """Split on a one-character separator, without trailing empty parts; a null value gives no parts."""
    trimmed = F.rtrim(value, F.lit(separator))
    nothing_left = (trimmed == "") & (value != "")
    return F.when(value.isNull() | nothing_left, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, separator)
    )


def tag_term(tag: Column) -> Column:
    return F.substring_index(tag, ":", 1)


def tag_score(tag: Column) -> Column:
    """The score of a tag, null when it is missing or not a number."""
    return F.try_element_at(F.split(tag, ":"), F.lit(2)).try_cast("double")


def is_null_term(term: Column) -> Column:
    return term.isin(NULL_TERM, "")


def is_positive_tag(tag: Column) -> Column:
    """A readable score decides by its sign; without one, every real term counts."""
    return F.coalesce(F.nanvl(tag_score(tag), F.lit(-1.0)) >= 0, ~is_null_term(tag_term(tag)))


def tag_names(value: Column) -> Column:
    """Terms of all tags in order; a null string gives the one term "null"."""
    return F.when(value.isNull(), F.array(F.lit(NULL_TERM))).otherwise(F.transform(split_parts(value, ","), tag_term))


def positive_tags(value: Column, top_k: int) -> Column:
    """Terms of the first `top_k` tags whose score is not negative, in order."""
    kept = F.slice(F.filter(split_parts(value, ","), is_positive_tag), 1, top_k)
    return F.when(value.isNull(), F.array(F.lit(NULL_TERM))).otherwise(F.transform(kept, tag_term))


def _before(values: Column, position: Column) -> Column:
    """The elements in front of a 1-based position; all of them for position 0."""
    return F.when(position == 0, values).otherwise(F.slice(values, F.lit(1), F.greatest(position - 1, F.lit(0)).cast("int")))


def leading_tags(tags: Column) -> Column:
    """The tags in front of the first one whose term is empty or "null"; the rest is not read."""

    def cut(values: Column) -> Column:
        bad = F.transform(values, lambda t: is_null_term(tag_term(t)))
        return _before(values, F.array_position(bad, F.lit(True)))

    return bind(tags, cut)


def key_value_part(value: Column, take_key: bool = True) -> Column:
    """Key or value of `key:value` as double, -1 when it is absent or not a number."""
    index = 1 if take_key else 2
    part = F.try_element_at(F.split(value, ":"), F.lit(index)).try_cast("double")
    return F.coalesce(part, F.lit(-1.0))


def clean_scored_term(value: Column) -> Column:
    """(term, 0.0) of a `term:score` whose score is not negative, else ("null", 0.0)."""
    keep = F.nanvl(tag_score(value), F.lit(-1.0)) >= 0
    return F.struct(
        F.when(keep, tag_term(value)).otherwise(F.lit(NULL_TERM)).alias("term"), F.lit(0.0).alias("prob")
    )


def tag_map(value: Column) -> Column:
    """`{a:1.0,b}` as map<string,double>: weight 1.0 when absent, the last weight of a repeated tag wins.

    A tag whose weight is not a number is left out.
    """
    inner = F.regexp_replace(value, r"^\{|\}$", "")
    tags = bind(split_parts(inner, ","), lambda parts: _before(parts, F.array_position(parts, F.lit(""))))

    def entry(tag: Column) -> Column:
        parts = split_parts(tag, ":")
        weight = F.when(F.size(parts) == 1, F.lit(1.0)).otherwise(tag_score(tag))
        return F.struct(tag_term(tag).alias("key"), weight.alias("value"))

    entries = F.filter(F.transform(tags, entry), lambda e: e["value"].isNotNull())
    keys = F.transform(entries, lambda e: e["key"])
    last_of_key = F.filter(
        entries, lambda e, i: F.array_position(F.reverse(keys), e["key"]) == F.size(keys) - i
    )
    distinct = F.size(F.array_distinct(keys)) == F.size(keys)
    return F.map_from_entries(F.when(distinct, entries).otherwise(last_of_key))
