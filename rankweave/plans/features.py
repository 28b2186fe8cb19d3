"""Queries: tag hashing, encodings, embedding lookup, similarity and score normalisation."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer, Interaction, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from rankweave.functions import encode, tag_hash, tags, vectors
from rankweave.functions.byte_hash import byte_hash
from rankweave.functions.scores import normalize_scores
from rankweave.models.batches import vector_parts
from rankweave.models.stages import ColumnProduct, TagHasher, TagUnionHasher, ValueOneHot
from rankweave.operators import naming, profile, sequences, similarity
from rankweave.plans import views
from rankweave.plans.catalog import query
from rankweave.plans.sql_hash import sql_byte_codes, sql_byte_hashes, sql_tag_hash

DIM = 1000
WIDTH = views.VECTOR_WIDTH


def _joined(values: Column) -> Column:
    """A list as comma-joined text, for comparing with SQL."""
    return F.array_join(values.cast("array<string>"), ",")


# SQL pieces: split parts, terms, the prefix in front of the first bad term, distinct sorted slots.
def _parts(column: str) -> str:
    return f"string_split(rtrim({column}, ','), ',')"


def _terms(parts: str) -> str:
    return f"list_transform({parts}, lambda t: string_split(t, ':')[1])"


def _before_bad(terms: str, values: str) -> str:
    stop = (
        f"least(coalesce(nullif(list_position({terms}, 'null'), 0), 99999), "
        f"coalesce(nullif(list_position({terms}, ''), 0), 99999))"
    )
    return f"list_slice({values}, 1, {stop} - 1)"


def _slots(terms: str, dim: int = DIM, seed: int = tag_hash.DEFAULT_SEED) -> str:
    return f"array_to_string(list_sort(list_distinct(list_transform({terms}, lambda t: {sql_tag_hash('t', seed)} % {dim}))), ',')"


_SCORE = "try_cast(string_split(t, ':')[2] AS DOUBLE)"
_POSITIVE = (
    f"list_filter(parts, lambda t: CASE WHEN {_SCORE} IS NOT NULL THEN {_SCORE} >= 0 "
    "ELSE string_split(t, ':')[1] NOT IN ('null', '') END)"
)
_TAG_PARTS = f"""WITH {views.TAGS}, split AS (
  SELECT *, {_parts('tags')} AS parts, {_terms(_parts('tags'))} AS terms FROM tags)"""


@query(
    "tag_hash",
    f"""WITH {views.TAGS}, words AS (
      SELECT item_id, unnest({_terms(_parts('tags'))}) AS term FROM tags)
    SELECT item_id, term, {sql_tag_hash('term')} AS h, {sql_tag_hash('term', 54321)} AS h2 FROM words""",
)
def hash_of_tags(spark, sf_dir):
    words = views.tags(spark, sf_dir).select("item_id", F.explode(tags.tag_names(F.col("tags"))).alias("term"))
    return words.select(
        "item_id", "term", tag_hash.tag_hash(F.col("term")).alias("h"), tag_hash.tag_hash(F.col("term"), 54321).alias("h2")
    )


@query("tag_hash_vector", f"{_TAG_PARTS} SELECT item_id, {_slots(_before_bad('terms', 'terms'))} AS slots FROM split")
def tag_hash_vector(spark, sf_dir):
    slots = tag_hash.tag_hash_slots(F.col("tags"), dim=DIM)
    return views.tags(spark, sf_dir).select("item_id", _joined(slots).alias("slots"))


@query(
    "tag_hash_positive",
    f"""{_TAG_PARTS}, kept AS (SELECT item_id, {_terms(f'list_slice({_POSITIVE}, 1, 2)')} AS kept FROM split)
    SELECT item_id, {_slots(_before_bad('kept', 'kept'), 300)} AS slots FROM kept""",
)
def tag_hash_positive(spark, sf_dir):
    slots = tag_hash.tag_hash_slots(F.col("tags"), dim=300, top_k=2, filter_positive=True)
    return views.tags(spark, sf_dir).select("item_id", _joined(slots).alias("slots"))


_WEIGHT_OK = (
    "list_filter(lead, lambda t: CASE WHEN len(string_split(t, ':')) = 2 "
    f"AND {_SCORE} IS NOT NULL THEN {_SCORE} > 0 ELSE true END)"
)


@query(
    "tag_hash_scored",
    f"""{_TAG_PARTS}, lead AS (SELECT item_id, {_before_bad('terms', 'parts')} AS lead FROM split)
    SELECT item_id, {_slots(_terms(_WEIGHT_OK))} AS slots FROM lead""",
)
def tag_hash_scored(spark, sf_dir):
    slots = tag_hash.scored_tag_hash_slots(F.col("tags"), dim=DIM)
    return views.tags(spark, sf_dir).select("item_id", _joined(slots).alias("slots"))


@query(
    "tag_hash_weighted",
    f"""WITH {views.TAGS}, entries AS (
      SELECT item_id, unnest({_parts('tags')}) AS t FROM tags WHERE tags <> ''),
    weights AS (
      SELECT item_id, string_split(t, ':')[1] AS term,
             CASE WHEN len(string_split(t, ':')) = 1 THEN 1.0 ELSE {_SCORE} END AS weight FROM entries),
    hashed AS (SELECT item_id, {sql_tag_hash('term')} % 5 AS slot, weight FROM weights)
    SELECT item_id, CAST(slot AS INTEGER) AS slot, sum(CAST(weight AS DOUBLE)) AS weight
    FROM hashed GROUP BY item_id, slot""",
)
def tag_hash_weighted(spark, sf_dir):
    parsed = tags.tag_map(F.concat(F.lit("{"), F.col("tags"), F.lit("}")))
    slots = tag_hash.weighted_tag_hash(parsed, dim=5)
    return views.tags(spark, sf_dir).select("item_id", F.inline(slots))


@query("string_hash", f"WITH {views.TAGS} SELECT item_id, CAST({sql_tag_hash('brand_tags')} % 100 AS INTEGER) AS slot FROM tags")
def string_hash(spark, sf_dir):
    slot = tag_hash.string_hash_slot(F.col("brand_tags"), 100)
    return views.tags(spark, sf_dir).select("item_id", slot.alias("slot"))


@query(
    "union_tag_hash",
    f"""{_TAG_PARTS}, terms AS (
      SELECT item_id, list_filter(list_concat({_terms(f'list_slice({_POSITIVE}, 1, 20)')}, {_terms(_parts('brand_tags'))}),
             lambda t: t NOT IN ('null', '')) AS merged FROM split)
    SELECT item_id, {_slots('merged', 10000, 54321)} AS slots FROM terms""",
)
def union_tag_hash(spark, sf_dir):
    hasher = TagUnionHasher(
        inputCols=["tags", "brand_tags"], outputCol="vec", dim=10000, topKs=[20, 20], filters=[True, False], seed=54321
    )
    hashed = hasher.transform(views.tags(spark, sf_dir))
    active = F.col("vec_parts.indices")
    return hashed.withColumn("vec_parts", F.unwrap_udt("vec")).select("item_id", _joined(active).alias("slots"))


@query(
    "murmur_bytes",
    f"""WITH texts AS (SELECT doc_id, {sql_byte_codes('text')} AS codes FROM documents), {sql_byte_hashes('texts')}
    SELECT doc_id, h32, h64, h128_1, h128_2 FROM byte_hashes""",
)
def murmur_bytes(spark, sf_dir):
    text = F.col("text")
    return views.table(spark, sf_dir, "documents").select(
        "doc_id",
        byte_hash(text, "hash32").alias("h32"),
        byte_hash(text, "hash64").alias("h64"),
        byte_hash(text, "hash128").alias("h128"),
    ).select("doc_id", "h32", "h64", F.col("h128")[0].alias("h128_1"), F.col("h128")[1].alias("h128_2"))


@query("duplicate_groups", "SELECT count(*) AS groups, sum(n)::BIGINT AS copies, max(n) AS largest FROM (SELECT count(*) AS n FROM documents GROUP BY text)")
def duplicate_groups(spark, sf_dir):
    groups = profile.duplicate_groups(views.table(spark, sf_dir, "documents"), "text")
    return groups.agg(
        F.count(F.lit(1)).alias("groups"), F.sum("copies").alias("copies"), F.max("copies").alias("largest")
    )


@query("tag_vocabulary", f"WITH {views.TAGS} SELECT DISTINCT unnest({_parts('tags')}) AS tag FROM tags")
def tag_vocabulary(spark, sf_dir):
    return profile.tag_vocabulary(views.tags(spark, sf_dir), "tags")


_VOCABULARY = f"vocabulary AS (SELECT DISTINCT unnest({_parts('tags')}) AS tag FROM tags)"


@query(
    "hash_collisions",
    f"""WITH {views.TAGS}, {_VOCABULARY}
    SELECT CAST({sql_tag_hash('tag')} % 300 AS INTEGER) AS bucket, count(*) AS tags FROM vocabulary GROUP BY 1""",
)
def hash_collisions(spark, sf_dir):
    return profile.hash_collisions(views.tags(spark, sf_dir), "tags")


@query(
    "hash_collisions_64",
    f"""WITH {views.TAGS}, {_VOCABULARY},
    texts AS (SELECT tag, {sql_byte_codes('substring(tag, 1, greatest(length(tag) - 2, 0))')} AS codes FROM vocabulary),
    {sql_byte_hashes('texts')}
    SELECT CAST(h64 % 150 + 150 AS INTEGER) AS bucket, count(*) AS tags FROM byte_hashes GROUP BY bucket""",
)
def hash_collisions_64(spark, sf_dir):
    return profile.hash_collisions(views.tags(spark, sf_dir), "tags", "hash64", mode="reference")


@query(
    "positive_tags",
    f"{_TAG_PARTS} SELECT item_id, array_to_string({_terms(f'list_slice({_POSITIVE}, 1, 2)')}, ',') AS names FROM split",
)
def positive_tags(spark, sf_dir):
    return views.tags(spark, sf_dir).select("item_id", _joined(tags.positive_tags(F.col("tags"), 2)).alias("names"))


@query("tag_names", f"{_TAG_PARTS} SELECT item_id, array_to_string(terms, ',') AS names FROM split")
def tag_names(spark, sf_dir):
    return views.tags(spark, sf_dir).select("item_id", _joined(tags.tag_names(F.col("tags"))).alias("names"))


@query(
    "extract_kv",
    f"""WITH {views.TAGS}
    SELECT item_id, coalesce(try_cast(string_split(size_price, ':')[1] AS DOUBLE), -1) AS key,
           coalesce(try_cast(string_split(size_price, ':')[2] AS DOUBLE), -1) AS value,
           coalesce(try_cast(string_split(tags, ':')[1] AS DOUBLE), -1) AS tag_key FROM tags""",
)
def extract_kv(spark, sf_dir):
    return views.tags(spark, sf_dir).select(
        "item_id",
        tags.key_value_part(F.col("size_price")).alias("key"),
        tags.key_value_part(F.col("size_price"), take_key=False).alias("value"),
        tags.key_value_part(F.col("tags")).alias("tag_key"),
    )


@query(
    "clean_kv",
    f"""WITH {views.TAGS}, scored AS (
      SELECT item_id, string_split(t, ':')[1] AS term, {_SCORE} AS score
      FROM (SELECT item_id, unnest({_parts('brand_tags')}) AS t FROM tags))
    SELECT item_id, CASE WHEN score >= 0 THEN term ELSE 'null' END AS term, 0.0::DOUBLE AS prob FROM scored""",
)
def clean_kv(spark, sf_dir):
    exploded = views.tags(spark, sf_dir).select("item_id", F.explode(tags.split_parts(F.col("brand_tags"), ",")).alias("t"))
    return exploded.select("item_id", tags.clean_scored_term(F.col("t")).alias("c")).select("item_id", "c.term", "c.prob")


@query(
    "tag_map",
    f"""WITH {views.TAGS}, entries AS (
      SELECT item_id, unnest({_parts('tags')}) AS t FROM tags WHERE tags <> '')
    SELECT item_id, string_split(t, ':')[1] AS tag,
           CASE WHEN len(string_split(t, ':')) = 1 THEN 1.0::DOUBLE ELSE {_SCORE} END AS weight FROM entries""",
)
def tag_map(spark, sf_dir):
    parsed = tags.tag_map(F.concat(F.lit("{"), F.col("tags"), F.lit("}")))
    return views.tags(spark, sf_dir).select("item_id", F.explode(parsed).alias("tag", "weight"))


_SIZES = [str(v) for v in range(1, 51, 7)]


@query(
    "value_one_hot",
    f"""WITH {views.TAGS}
    SELECT item_id, coalesce(CAST(nullif(list_position({_SIZES!r}, CAST(p_size AS VARCHAR)), 0) - 1 AS VARCHAR), '') AS slots,
           CASE WHEN list_contains({_SIZES!r}, CAST(p_size AS VARCHAR)) THEN '0' ELSE '' END AS reference_slots
    FROM tags""",
)
def value_one_hot(spark, sf_dir):
    size = F.col("p_size")
    return views.tags(spark, sf_dir).select(
        "item_id",
        _joined(encode.value_one_hot(size.cast("double"), _SIZES)).alias("slots"),
        _joined(encode.value_one_hot(size, _SIZES, mode="reference")).alias("reference_slots"),
    )


_BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@query(
    "label_one_hot",
    f"""WITH {views.TAGS}
    SELECT item_id, coalesce(CAST(nullif(list_position({_BRANDS!r}, p_brand), 0) - 1 AS VARCHAR), '') AS slots FROM tags""",
)
def label_one_hot(spark, sf_dir):
    slots = encode.label_one_hot(F.col("p_brand"), _BRANDS, invalid="zeros")
    return views.tags(spark, sf_dir).select("item_id", _joined(slots).alias("slots"))


_THRESHOLDS = [0.0, 10.0, 25.0, 50.0, 100.0]


@query(
    "threshold_one_hot",
    f"""WITH {views.INTERACTIONS}, slotted AS (
      SELECT event_id, len(list_filter({_THRESHOLDS}, lambda t: value - 5 >= t)) - 1 AS slot FROM interactions)
    SELECT event_id, CASE WHEN slot >= 0 AND slot < {len(_THRESHOLDS) - 1} THEN CAST(slot AS VARCHAR) ELSE '' END AS slots
    FROM slotted""",
)
def threshold_one_hot(spark, sf_dir):
    slots = encode.threshold_one_hot(F.col("value") - 5, _THRESHOLDS)
    return views.interactions(spark, sf_dir).select("event_id", _joined(slots).alias("slots"))


@query(
    "bucketize",
    f"""WITH {views.INTERACTIONS}
    SELECT event_id, CAST(len(list_filter({_THRESHOLDS}, lambda t: value >= t)) AS DOUBLE) AS bucket,
           CAST(len(list_filter({_THRESHOLDS}, lambda t: value >= t)) AS INTEGER) AS bucket_index FROM interactions""",
)
def bucketize(spark, sf_dir):
    rows = views.interactions(spark, sf_dir).select("event_id", "value")
    bucketizer = Bucketizer(
        splits=[-float("inf"), *_THRESHOLDS, float("inf")], inputCol="value", outputCol="bucket", handleInvalid="keep"
    )
    indexed = bucketizer.transform(rows)
    return indexed.select("event_id", "bucket", encode.bucket_index(F.col("value"), _THRESHOLDS).alias("bucket_index"))


@query(
    "leaf_one_hot",
    """SELECT l_orderkey, l_linenumber, l_partkey,
           array_to_string([l_partkey % 8, 8 + l_suppkey % 8, 16 + l_linenumber % 8], ',') AS slots FROM lineitem""",
)
def leaf_one_hot(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    leaves = F.array(
        (F.col("l_partkey") % 8).cast("float"), (F.col("l_suppkey") % 8).cast("float"), (F.col("l_linenumber") % 8).cast("float")
    )
    slots = encode.leaf_one_hot(leaves, depth=2)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", _joined(slots).alias("slots"))


@query(
    "split_columns",
    f"""WITH {views.TAGS} SELECT item_id, string_split(brand_tags, ',')[1] AS col_0, string_split(brand_tags, ',')[2] AS col_1,
    string_split(brand_tags, ',')[3] AS col_2 FROM tags""",
)
def split_columns(spark, sf_dir):
    rows = views.tags(spark, sf_dir).select("item_id", "brand_tags")
    split, names = encode.split_columns(rows, "brand_tags", 3)
    return split.select("item_id", *names)


@query(
    "assemble_interact",
    f"""WITH {views.TAGS} SELECT item_id, CAST(p_size AS DOUBLE) * p_retailprice AS first,
    CAST(p_size AS DOUBLE) * (p_size % 3) AS second FROM tags""",
)
def assemble_interact(spark, sf_dir):
    rows = views.tags(spark, sf_dir).withColumn("small", F.col("p_size") % 3)
    rows = VectorAssembler(inputCols=["p_size"], outputCol="left").transform(rows)
    rows = VectorAssembler(inputCols=["p_retailprice", "small"], outputCol="right").transform(rows)
    rows = Interaction(inputCols=["left", "right"], outputCol="product").transform(rows)
    return rows.select("item_id", vector_to_array("product").alias("p")).select(
        "item_id", F.col("p")[0].alias("first"), F.col("p")[1].alias("second")
    )


WIDE = 50_000


@query(
    "wide_products",
    f"""{_TAG_PARTS}, lead AS (SELECT item_id, {_before_bad('terms', 'terms')} AS lead FROM split),
    wide AS (
      SELECT DISTINCT item_id, unnest(list_transform(lead, lambda t: {sql_tag_hash('t')} % {WIDE})) AS slot FROM lead)
    SELECT item_id, CAST(slot * 3 + p_size % 3 AS INTEGER) AS slot, p_retailprice AS value,
           count(*) OVER (PARTITION BY item_id) AS slots
    FROM wide JOIN tags USING (item_id) WHERE p_retailprice <> 0""",
)
def wide_products(spark, sf_dir):
    """A tag column of 50,000 slots times a one-hot of three values times a number."""
    rows = views.tags(spark, sf_dir).withColumn("small", F.col("p_size") % 3)
    rows = TagHasher(inputCol="tags", outputCol="wide", dim=WIDE).transform(rows)
    rows = ValueOneHot(inputCol="small", outputCol="hot", values=["0", "1", "2"]).transform(rows)
    rows = ColumnProduct(inputCols=["wide", "hot", "p_retailprice"], widths=[0, 0, 0], outputCol="product").transform(rows)
    places, values = vector_parts(F.col("product"))
    pairs = rows.select("item_id", F.size(places).cast("long").alias("slots"), F.explode(F.arrays_zip(places.alias("slot"), values.alias("value"))).alias("e"))
    return pairs.select("item_id", "e.slot", "e.value", "slots")


@query(
    "cosine_pairs",
    f"""WITH {views.DAILY_VECTORS}
    SELECT id, dt, round(list_dot_product(vec, prev) /
           (CASE WHEN list_dot_product(vec, vec) = 0 THEN 1 ELSE sqrt(list_dot_product(vec, vec)) END
            * CASE WHEN list_dot_product(prev, prev) = 0 THEN 1 ELSE sqrt(list_dot_product(prev, prev)) END), 6) AS cosine
    FROM (SELECT a.id, a.dt, a.vec, b.vec AS prev FROM daily_vectors a JOIN vectors b USING (id))""",
)
def cosine_pairs(spark, sf_dir):
    daily = views.daily_vectors(spark, sf_dir)
    plain = views.vectors(spark, sf_dir).select("id", F.col("vec").alias("plain"))
    cosine = vectors.cosine_similarity(F.col("vec"), F.col("plain"))
    return daily.join(plain, "id").select("id", "dt", F.round(cosine, 6).alias("cosine"))


@query(
    "prev_day_vectors",
    f"""WITH {views.INTERACTIONS}, {views.DAILY_VECTORS}
    SELECT event_id, feed_id, label_date, coalesce(round(v.vec[1], 6), 0.0) AS first,
           coalesce(round(list_dot_product(v.vec, v.vec), 6), 0.0) AS squares
    FROM interactions i LEFT JOIN daily_vectors v
      ON v.id = i.feed_id AND v.dt = strftime(CAST(i.label_date AS DATE) - 1, '%Y-%m-%d')""",
)
def prev_day_vectors(spark, sf_dir):
    rows = views.interactions(spark, sf_dir).select("event_id", "feed_id", "label_date")
    looked_up = similarity.previous_day_vectors(
        rows, views.daily_vectors(spark, sf_dir), "feed_id", WIDTH, "vec", salt_by=["event_id"]
    )
    vec = F.col("vec")
    return looked_up.select(
        "event_id",
        "feed_id",
        "label_date",
        F.round(vec[0], 6).alias("first"),
        F.round(vectors.dot(vec, vec), 6).alias("squares"),
    )


@query(
    "history_similarity",
    f"""WITH {views.INTERACTIONS}, {views.DAILY_VECTORS},
    history AS (
      SELECT device_id, strftime(CAST(label_date AS DATE) + 1, '%Y-%m-%d') AS label_date, feed_id FROM interactions WHERE label = 1),
    target AS (
      SELECT i.event_id, i.device_id, i.label_date, v.vec
      FROM interactions i LEFT JOIN daily_vectors v
        ON v.id = i.feed_id AND v.dt = strftime(CAST(i.label_date AS DATE) - 1, '%Y-%m-%d')),
    past AS (
      SELECT h.device_id, h.label_date, v.vec
      FROM history h LEFT JOIN daily_vectors v
        ON v.id = h.feed_id AND v.dt = strftime(CAST(h.label_date AS DATE) - 1, '%Y-%m-%d'))
    SELECT t.event_id, round(coalesce(avg(CASE WHEN p.device_id IS NULL THEN NULL
             WHEN p.vec IS NULL OR t.vec IS NULL THEN 0.0 ELSE list_cosine_similarity(t.vec, p.vec) END), 0.0), 6) AS history_sim
    FROM target t LEFT JOIN past p USING (device_id, label_date) GROUP BY t.event_id""",
)
def history_similarity(spark, sf_dir):
    rows = views.interactions(spark, sf_dir)
    # The history table of a day, exploded: positive items by device and day.
    items = rows.where(F.col("label") == 1).select("device_id", F.col("label_date").alias("dt"), "feed_id")
    scored = similarity.add_history_similarity(
        rows.select("event_id", "device_id", "feed_id", "label_date"),
        items,
        views.daily_vectors(spark, sf_dir),
        WIDTH,
        salt_by=["event_id"],
    )
    return scored.select("event_id", F.round("history_sim", 6).alias("history_sim"))


@query(
    "similar_topk",
    f"""WITH {views.VECTORS}, ranked AS (
      SELECT a.id AS query_id, b.id AS item_id, list_cosine_similarity(a.vec, b.vec) AS score,
             row_number() OVER (PARTITION BY a.id ORDER BY list_cosine_similarity(a.vec, b.vec) DESC, b.id) AS rank
      FROM vectors a JOIN vectors b ON a.id <> b.id)
    SELECT query_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 10""",
)
def similar_topk(spark, sf_dir):
    found = similarity.similar_items(views.vectors(spark, sf_dir), 10)
    return found.select("query_id", "item_id", F.round("score", 6).alias("score"), "rank")


_USER_FACTORS = f"""user_factors AS (
  SELECT device_id AS id, list(m ORDER BY dim) AS vec FROM (
    SELECT device_id, dim, avg(v) AS m FROM (
      SELECT i.device_id, unnest(generate_series(1, {WIDTH})) AS dim, unnest(vec) AS v
      FROM interactions i JOIN vectors ON id = feed_id WHERE i.label = 1) GROUP BY device_id, dim) GROUP BY device_id)"""


def _user_factors(spark, sf_dir):
    """Mean embedding of the items a device reacted to."""
    rows = views.interactions(spark, sf_dir).where(F.col("label") == 1)
    times = rows.groupBy("device_id", "feed_id").agg(F.count(F.lit(1)).alias("n"))
    joined = times.join(views.vectors(spark, sf_dir).select(F.col("id").alias("feed_id"), "vec"), "feed_id")
    means = [F.sum(F.col("vec")[i] * F.col("n")) / F.sum("n") for i in range(WIDTH)]
    return joined.groupBy(F.col("device_id").alias("id")).agg(F.array(*means).alias("vec"))


def _topn_sql(query_table: str, item_table: str, n: int) -> str:
    return f"""WITH {views.INTERACTIONS}, {views.VECTORS}, {_USER_FACTORS}, ranked AS (
      SELECT a.id AS query_id, b.id AS item_id, list_dot_product(a.vec, b.vec) AS score,
             row_number() OVER (PARTITION BY a.id ORDER BY list_dot_product(a.vec, b.vec) DESC, b.id) AS rank
      FROM {query_table} a CROSS JOIN {item_table} b)
    SELECT query_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= {n}"""


@query("topn_items_for_users", _topn_sql("user_factors", "vectors", 100))
def topn_items_for_users(spark, sf_dir):
    items = views.vectors(spark, sf_dir).select("id", "vec")
    found = similarity.top_n_by_dot(_user_factors(spark, sf_dir), items, 100)
    return found.select("query_id", "item_id", F.round("score", 6).alias("score"), "rank")


@query(
    "recommendation_names",
    f"""WITH {views.INTERACTIONS}, {views.VECTORS}, {_USER_FACTORS}, ranked AS (
      SELECT a.id AS device_id, b.id AS item, list_dot_product(a.vec, b.vec) AS score,
             row_number() OVER (PARTITION BY a.id ORDER BY list_dot_product(a.vec, b.vec) DESC, CAST(b.id AS BIGINT)) AS rank
      FROM user_factors a CROSS JOIN vectors b)
    SELECT device_id, CAST(rank AS INTEGER) AS rank, p_name AS name FROM ranked LEFT JOIN part ON p_partkey = CAST(item AS BIGINT)
    WHERE rank <= 30""",
)
def recommendation_names(spark, sf_dir):
    """The best 30 items of each device, from given factors, with the items' names; some items have none."""
    items = views.vectors(spark, sf_dir).select(F.col("id").cast("long").alias("id"), "vec")
    ranked = similarity.top_n_by_dot(_user_factors(spark, sf_dir), items, 30)
    lists = similarity.as_lists(ranked, output="ids")
    names = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    named = naming.name_lists(lists, names, "query_id")
    return named.select(F.col("query_id").alias("device_id"), F.posexplode("names").alias("rank", "name")).withColumn("rank", F.col("rank") + 1)


@query("topn_users_for_items", _topn_sql("vectors", "user_factors", 20))
def topn_users_for_items(spark, sf_dir):
    items = views.vectors(spark, sf_dir).select("id", "vec")
    found = similarity.top_n_by_dot(items, _user_factors(spark, sf_dir), 20)
    return found.select("query_id", "item_id", F.round("score", 6).alias("score"), "rank")


@query(
    "score_normalise",
    f"""WITH {views.INTERACTIONS}, stats AS (
      SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM interactions GROUP BY event_type),
    z AS (SELECT event_id, (value - m) / s AS z, 0.707106781::DOUBLE * (value - m) / s AS x FROM interactions JOIN stats USING (event_type)),
    t AS (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + 0.3275911::DOUBLE * abs(x)) AS t FROM z),
    e AS (SELECT *, sign(x) * (1.0::DOUBLE - t * (0.254829592::DOUBLE + t * (-0.284496736::DOUBLE + t * (1.421413741::DOUBLE
          + t * (-1.453152027::DOUBLE + t * 1.061405429::DOUBLE)))) * exp(-x * x)) AS e FROM t)
    SELECT event_id, round(0.5::DOUBLE + 0.5::DOUBLE * e, 6) AS cdf, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-z)), 6) AS logistic FROM e""",
)
def score_normalise(spark, sf_dir):
    rows = views.interactions(spark, sf_dir).select("event_id", "event_type", "value")
    by_cdf = normalize_scores(rows, "value", ["event_type"]).withColumnRenamed("value_norm", "cdf")
    both = normalize_scores(by_cdf, "value", ["event_type"], method="sigmoid")
    return both.select("event_id", F.round("cdf", 6).alias("cdf"), F.round("value_norm", 6).alias("logistic"))


@query(
    "history_text_items",
    f"WITH {views.INTERACTIONS} SELECT device_id, label_date AS dt, feed_id FROM interactions WHERE label = 1",
)
def history_text_items(spark, sf_dir):
    """Items of histories that are kept as blank-joined texts."""
    rows = views.interactions(spark, sf_dir)
    history = sequences.as_text(sequences.user_history(rows, F.col("label_date")), "feeds")
    return similarity.history_items(history)
