"""DuckDB SQL for the queries that SQL can express."""

from valuelens.llm.licenses import TEMPLATES

HOST_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), windows AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM w, unnest(range(1, len(ws) - 1)) AS u(i)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), repeats AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, unnest([0, 1, 2]) AS v(k) GROUP BY r
), c AS (
  SELECT w.r, doc_id, source, len(ws) AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(ls) AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN repeats USING (r)
), f AS (
  SELECT *, n_words < 50 AS a, 100 * n_repeat_words > 50 * n_words AS b,
    100 * n_symbols > 30 * word_chars AS s, 100 * n_dup_lines > 50 * n_lines AS l FROM c
), h AS (
  SELECT source, rule, count(*) AS n, sum(x::INT) AS x
  FROM (SELECT source, unnest(['a', 'b', 's', 'l']) AS rule, unnest([a, b, s, l]) AS x FROM f WHERE source IS NOT NULL)
  GROUP BY ALL
), m AS (
  SELECT rule, avg(x / n) AS mean, var_pop(x / n) AS v FROM h GROUP BY rule
), p AS (
  SELECT rule, mean, CASE WHEN v = 0 THEN 1e6 ELSE least(1e6, greatest(0, mean * (1 - mean) / v - 1)) END AS k FROM m
), bad AS (
  SELECT DISTINCT source FROM h JOIN p USING (rule)
  WHERE (x + mean * k) / (n + k) > CASE WHEN rule IN ('a', 'b') THEN 0.8 ELSE 0.9 END
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, a OR b AS base_failed,
  NOT (a OR b) AND source IS DISTINCT FROM bad_source AS kept
FROM f LEFT JOIN (SELECT source AS bad_source FROM bad) ON source = bad_source
"""

CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1
    + length(regexp_replace(text, '<(\\*)\|(im_start|im_end)\|>', '<\1\\|\2|>', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

#: Blocks begin at a word of their template and are as long as the length filter allows.
LICENSES = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM d
), phrases(label, p) AS (
  VALUES ('cc-by', ['cc', 'by']), ('gpl', ['general', 'public', 'license']), ('reserved', ['all', 'rights', 'reserved'])
), places AS (
  SELECT r, label, i - 1 AS word FROM w JOIN phrases ON list_has_all(ws, p), unnest(range(1, len(ws) + 1)) AS u(i)
  WHERE ws[i:i + len(p) - 1] = p
), base AS (
  SELECT r, count(*) AS n, min(word) AS a, max(word) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS l
  FROM places GROUP BY r
), templates(label, body) AS (
  VALUES @templates
), tw AS (
  SELECT DISTINCT label, unnest(regexp_extract_all(body, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM templates
), need AS (
  SELECT label, count(*) AS n FROM tw GROUP BY label
), lengths AS (
  SELECT label, len(regexp_extract_all(body, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) * 5 // 4 AS most FROM templates
), hits AS (
  SELECT r, label, i, ws[i] AS word
  FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM w) JOIN tw ON word = ws[i]
), able AS (
  SELECT r, label FROM hits JOIN need USING (label) GROUP BY r, label HAVING 5 * count(DISTINCT word) >= 4 * any_value(n)
), near AS (
  SELECT * FROM hits SEMI JOIN able USING (r, label)
), met AS (
  SELECT a.r, a.label, count(DISTINCT b.word) / any_value(n) AS share
  FROM near a JOIN need USING (label) JOIN lengths USING (label)
    JOIN near b ON b.r = a.r AND b.label = a.label AND b.i >= a.i AND b.i < a.i + most
  GROUP BY a.r, a.label, a.i HAVING 5 * count(DISTINCT b.word) >= 4 * any_value(n)
), found AS (
  SELECT r, max(share) AS share FROM met GROUP BY r
), named AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS l
  FROM (SELECT r, label FROM met UNION ALL SELECT r, label FROM places) GROUP BY r
)
SELECT doc_id, len(ws) AS n_words, coalesce(base.n, 0) AS n_base, base.a AS first_word, base.z AS last_word,
  coalesce(base.l, '') AS base_labels, coalesce(named.l, '') AS labels,
  CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(found.share, 0) END::DOUBLE AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN found USING (r) LEFT JOIN named USING (r)
""".replace("@templates", ", ".join(f"('{label}', '{text}')" for label, text in TEMPLATES.items()))

#: Splits, keys and the first document that holds a repeated key.
LINES = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT r, doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), firsts AS (
  SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
)
SELECT any_value(k.doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (k.doc_id <> first_doc) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (first_doc IS NULL OR k.doc_id IS NULL OR k.doc_id = first_doc), '')) AS kept_sha256
FROM k LEFT JOIN firsts USING (key) GROUP BY r
"""

#: The CRC is worked out byte by byte, from a table that its polynomial gives.
RESAMPLING = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), texts AS (
  SELECT row_number() OVER () AS r, true AS own, doc_id, text FROM documents
  UNION ALL SELECT -row_number() OVER (), false, NULL, text FROM benchmark
), w AS (
  SELECT r, own, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts
), f AS (
  SELECT r, unnest(ws) AS g FROM w
  UNION ALL SELECT r, unnest(list_transform(list_zip(ws[:-2], ws[2:]), lambda z: z[1] || ' ' || z[2])) FROM w WHERE len(ws) > 1
), g AS (
  SELECT g, hex(encode(g)) AS h FROM (SELECT DISTINCT g FROM f)
), b AS (
  SELECT g, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM g, crc_table
), c AS (
  SELECT r, bucket, count(*) AS n FROM f JOIN b USING (g) GROUP BY r, bucket
), h AS (
  SELECT bucket, coalesce(sum(n) FILTER (r > 0), 0) AS s, coalesce(sum(n) FILTER (r < 0), 0) AS t FROM c GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000) / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM h
), weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight FROM c JOIN gains USING (bucket) GROUP BY r
), scores AS (
  SELECT r, doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN weights USING (r) WHERE own
), places AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM scores LEFT JOIN places USING (r)
"""

#: Three searches for the nearest entries; the first two are followed by new means.
CODES = r"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), parts AS (
  SELECT vec_id, p, v[p * len(v) // 16 + 1:(p + 1) * len(v) // 16] AS x FROM kept, unnest(range(16)) AS u(p)
), book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts QUALIFY e < 64
), @rounds
sums AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near2 GROUP BY vec_id),
labels AS (SELECT label, sum(error)::BIGINT AS label_error FROM kept JOIN sums USING (vec_id) GROUP BY label)
SELECT vec_id, code, error, label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM kept JOIN sums USING (vec_id) JOIN labels ON kept.label IS NOT DISTINCT FROM labels.label
""".replace("@rounds", "\n".join(
    [f"""near{k} AS (
  SELECT vec_id, p, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM (
    SELECT vec_id, p, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM parts JOIN book{k} USING (p)
  ) GROUP BY vec_id, p
),""" + (f""" means{k} AS (
  SELECT p, e, list(m ORDER BY j) AS c FROM (
    SELECT p, e, j, floor(sum(x[j]) / count(*))::BIGINT AS m
    FROM near{k} JOIN parts USING (vec_id, p), unnest(range(1, len(x) + 1)) AS u(j) GROUP BY p, e, j
  ) GROUP BY p, e
), book{k + 1} AS (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN means{k} m USING (p, e)),""" if k<2 else "") for k in range(3)]))

ORACLE: dict[str, str] = {
    "op4_host_rules": HOST_RULES,
    "op8_chat_round_trip": CHAT,
    "op9_license_scan": LICENSES,
    "op11_line_dedup": LINES,
    "op12_target_resampling": RESAMPLING,
    "op13_vector_codes": CODES,
}
