"""SQL twins of the queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

from rankweave.llm import licenses

SHARDING = """
WITH table_of_crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS entry
), sized AS (
  SELECT doc_id, coalesce(text, '') AS body, octet_length(encode(coalesce(text, ''))) + 8 AS size,
    ('0x' || md5(coalesce(text, ''))[1:3])::INT AS r,
    ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:2])::INT AS p
  FROM documents
), summed AS (
  SELECT *, sum(size) OVER (ORDER BY r, p, doc_id, size) - size AS before, sum(size) OVER () AS total FROM sized
), dealt AS (
  SELECT *, least(23, before * 24 // total)::INT AS shard FROM summed
), hexed AS (
  SELECT *, hex(encode(body)) AS digits FROM dealt
), bytes AS (
  SELECT * EXCLUDE (digits), list_transform(regexp_extract_all(digits, '..'), lambda d: ('0x' || d)::BIGINT) AS codes
  FROM hexed
)
SELECT doc_id, size::BIGINT AS size,
  xor(list_reduce(codes, lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)::BIGINT AS text_crc32,
  'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY r, p, doc_id, size) - 1 AS slot,
  NULL::INT AS grown_shard
FROM bytes, table_of_crc
"""

MIDDLE = """
WITH numbered AS (
  SELECT doc_id, coalesce(text, '') AS body, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d
  FROM documents
), drawn AS (
  SELECT *, ('0x' || d[1:8])::BIGINT % (n + 1) AS x, ('0x' || d[9:16])::BIGINT % (n + 1) AS y,
    CASE WHEN n = 0 OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR ('0x' || d[17:24])::BIGINT % 100 >= 90
      THEN 'plain' WHEN ('0x' || d[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbered
), cut AS (
  SELECT *, least(x, y) AS a, greatest(x, y) AS b FROM drawn
), parted AS (
  SELECT *, substring(body, 1, a) AS prefix, substring(body, a + 1, b - a) AS middle, substring(body, b + 1) AS suffix FROM cut
), joined AS (
  SELECT *, CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output
  FROM parted
), found AS (
  SELECT *, strpos(output, '<P>') AS p, strpos(output, '<S>') AS s, strpos(output, '<M>') AS m FROM joined
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN substring(output, 4, s - 4) || substring(output, m + 3) || substring(output, s + 3, m - s - 3)
    ELSE substring(output, p + 3, m - p - 3) || substring(output, m + 3) || substring(output, 4, p - 4) END) AS restored_sha256
FROM found
"""

IMPORTANCE = r"""
WITH table_of_crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS entry
), words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), wanted AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark
), given AS (
  SELECT doc_id, unnest(w) AS word FROM words
), vocabulary AS (
  SELECT word FROM given UNION SELECT word FROM wanted
), coded AS (
  SELECT word, list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda d: ('0x' || d)::BIGINT) AS codes FROM vocabulary
), hashed AS (
  SELECT word, xor(list_reduce(codes, lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM coded, table_of_crc
), source_counts AS (
  SELECT bucket, count(*) AS s FROM given JOIN hashed USING (word) GROUP BY bucket
), target_counts AS (
  SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (word) GROUP BY bucket
), gained AS (
  SELECT b.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM source_counts) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM target_counts) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT unnest(range(10000)) AS bucket) b LEFT JOIN source_counts USING (bucket) LEFT JOIN target_counts USING (bucket)
), weighed AS (
  SELECT doc_id, sum(gain) AS weight FROM given JOIN hashed USING (word) JOIN gained USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5)::DOUBLE / 4294967296::DOUBLE))))::BIGINT AS score
  FROM words LEFT JOIN weighed USING (doc_id)
), drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () * 10 // 100 AS most FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= most THEN rank END AS rank FROM scored LEFT JOIN drawn USING (doc_id)
"""

JACCARD = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM worded
), sets AS (
  SELECT min(doc_id) AS rep, list_sort(s) AS s FROM shingled WHERE len(s) > 0 GROUP BY list_sort(s)
), elements AS (
  SELECT rep, len(s) AS n, unnest(s) AS e FROM sets
), linked AS (
  SELECT a.rep AS a, b.rep AS b FROM elements a JOIN elements b ON a.e = b.e AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reached AS (
  SELECT rep AS node, rep AS other FROM sets
  UNION
  SELECT r.node, l.b FROM reached r JOIN both_ways l ON r.other = l.a
), grouped AS (
  SELECT node, min(other) AS component FROM reached GROUP BY node
)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(g.component, d.doc_id) AS component_id
FROM shingled d LEFT JOIN sets k ON list_sort(d.s) = k.s LEFT JOIN grouped g ON k.rep = g.node
"""


def _turned(x: str, bits: int) -> str:
    return f"(((({x}) << {bits}) & 18446744073709551615::UHUGEINT) | (({x}) >> {64 - bits}))"


def _times(x: str, prime: str) -> str:
    return f"((({x}) * {prime}::UHUGEINT) & 18446744073709551615::UHUGEINT)"


#: XXH64 with seed 42, step by step: `codes` are the bytes of a shingle as UHUGEINT. The primes are the specification's.
_XXH64 = f"""
numbered AS (
  SELECT *, len(codes) AS n, list_transform(range(len(codes) // 8), lambda i: {" + ".join(f"(codes[8 * i + {k + 1}] << {8 * k})" for k in range(8))}) AS eights
  FROM coded
), multiplied AS (
  SELECT *, list_transform(eights, lambda k: {_times("k", "14029467366897019727")}) AS inputs FROM numbered
), rounded AS (
  SELECT *, list_transform(list_transform(inputs, lambda k: {_turned("k", 31)}), lambda k: {_times("k", "11400714785074694791")}) AS rounds,
    {", ".join(f"list_reduce(list_prepend({start}::UHUGEINT, list_transform(range(n // 32), lambda i: inputs[4 * i + {j + 1}])), lambda a, k: {_times(_turned('(a + k) & 18446744073709551615::UHUGEINT', 31), '11400714785074694791')}) AS v{j}" for j, start in enumerate(["6983438078262162944", "14029467366897019769", "42", "7046029288634856867"]))}
  FROM multiplied
), merged AS (
  SELECT *, (({" + ".join(_turned(f"v{j}", bits) for j, bits in enumerate([1, 7, 12, 18]))}) & 18446744073709551615::UHUGEINT) AS m,
    {", ".join(f"{_times(_turned(_times(f'v{j}', '14029467366897019727'), 31), '11400714785074694791')} AS w{j}" for j in range(4))}
  FROM rounded
), begun AS (
  SELECT *, ((CASE WHEN n >= 32 THEN list_reduce([m, w0, w1, w2, w3], lambda a, w: ({_times("xor(a, w)", "11400714785074694791")} + 9650029242287828579::UHUGEINT) & 18446744073709551615::UHUGEINT)
    ELSE 2870177450012600303::UHUGEINT END + n::UHUGEINT) & 18446744073709551615::UHUGEINT) AS h0
  FROM merged
), by_eights AS (
  SELECT *, list_reduce(list_prepend(h0, rounds[n // 32 * 4 + 1 : n // 8]), lambda a, k: ({_times(_turned("xor(a, k)", 27), "11400714785074694791")} + 9650029242287828579::UHUGEINT) & 18446744073709551615::UHUGEINT) AS h1
  FROM begun
), by_four AS (
  SELECT *, CASE WHEN n % 8 >= 4 THEN xor(h1, {_times("(" + " + ".join(f"(codes[n // 8 * 8 + {k + 1}] << {8 * k})" for k in range(4)) + ")", "11400714785074694791")}) END AS f FROM by_eights
), after_four AS (
  SELECT *, CASE WHEN f IS NULL THEN h1 ELSE ({_times(_turned("f", 23), "14029467366897019727")} + 1609587929392839161::UHUGEINT) & 18446744073709551615::UHUGEINT END AS h2 FROM by_four
), by_bytes AS (
  SELECT *, list_reduce(list_prepend(h2, list_transform(codes[n // 4 * 4 + 1 : n], lambda c: {_times("c", "2870177450012600261")})), lambda a, c: {_times(_turned("xor(a, c)", 11), "11400714785074694791")}) AS h3
  FROM after_four
), mixed_once AS (
  SELECT *, {_times("xor(h3, h3 >> 33)", "14029467366897019727")} AS h4 FROM by_bytes
), mixed_twice AS (
  SELECT *, {_times("xor(h4, h4 >> 29)", "1609587929392839161")} AS h5 FROM mixed_once
), hashed AS (
  SELECT shingle, xor(h5, h5 >> 32) AS h FROM mixed_twice
)"""

SIMHASH = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingled AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM worded
), coded AS (
  SELECT shingle, list_transform(regexp_extract_all(hex(encode(shingle)), '..'), lambda d: ('0x' || d)::BIGINT::UHUGEINT) AS codes
  FROM (SELECT DISTINCT shingle FROM shingled)
), {_XXH64}, counted AS (
  SELECT doc_id, count(*) AS n, {", ".join(f"sum(((h >> {b}) & 1::UHUGEINT)::INT) AS b{b}" for b in range(64))}
  FROM shingled JOIN hashed USING (shingle) GROUP BY doc_id
), printed AS (
  SELECT d.doc_id, coalesce({" + ".join(f"(CASE WHEN 2 * b{b} > n THEN 1::HUGEINT << {b} ELSE 0::HUGEINT END)" for b in range(64))}, 0::HUGEINT) AS fp
  FROM documents d LEFT JOIN counted USING (doc_id)
), classes AS (
  SELECT fp, min(doc_id) AS rep FROM printed GROUP BY fp
), linked AS (
  SELECT a.rep AS a, b.rep AS b FROM classes a JOIN classes b ON a.rep <> b.rep AND bit_count(xor(a.fp, b.fp)) <= 2
), reached AS (
  SELECT rep AS node, rep AS other FROM classes
  UNION
  SELECT r.node, l.b FROM reached r JOIN linked l ON r.other = l.a
), grouped AS (
  SELECT node, min(other) AS component FROM reached GROUP BY node
)
SELECT doc_id, lower(lpad(hex(fp::UBIGINT), 16, '0')) AS fingerprint, component AS component_id
FROM printed JOIN classes USING (fp) JOIN grouped ON rep = node
"""


def _canonical(text: str) -> str:
    out = f"""array_to_string(list_filter(string_split(translate({text}, '{licenses._UPPER}', '{licenses._LOWER}'), chr(10)),
      lambda line: NOT regexp_matches(line, '{licenses._OWNER_LINE}') AND NOT regexp_matches(line, '{licenses._RIGHTS_LINE}')), chr(10))"""
    for spelling, usual in licenses.SPELLINGS:
        out = f"replace({out}, '{spelling}', '{usual}')"
    return f"trim(regexp_replace({out}, '[^a-z0-9]+', ' ', 'g'))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LICENSES = f"""
WITH known AS (
  SELECT DISTINCT license, {_canonical("wording")} AS form
  FROM (VALUES {", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in licenses.TEXTS)}) AS t(license, wording)
), entries AS (
  SELECT doc_id, 0 AS line, text AS entry FROM documents
  UNION ALL
  SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)), unnest(string_split(text, chr(10))) FROM documents
), formed AS (
  SELECT doc_id, line, {_canonical("entry")} AS form FROM entries
)
SELECT doc_id, line::INT AS line, license FROM formed JOIN known USING (form)
"""
