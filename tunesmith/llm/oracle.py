"""SQL of those queries that SQL can express."""

_RULE_NAMES = ("base", "symbols", "lines")


def _prior(rule: str) -> str:
    return f"""
  SELECT '{rule}' AS rule, m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 1000.0) ELSE 1000.0 END AS k
  FROM (SELECT m, (SELECT sum(n * (x_{rule} / n - m) ** 2) / sum(n) FROM hosts) AS v
        FROM (SELECT sum(x_{rule}) / sum(n) AS m FROM hosts))"""


HOST_RULES = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT r, w, row_number() OVER (PARTITION BY r ORDER BY i) AS i
  FROM (SELECT r, unnest(string_split_regex(t, '[\x20\x09-\x0D]+')) AS w, generate_subscripts(string_split_regex(t, '[\x20\x09-\x0D]+'), 1) AS i FROM docs)
  WHERE w <> ''),
sized AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM words GROUP BY r),
windows AS (
  SELECT r, i, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS g, lead(w, 4) OVER o AS last
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows WHERE last IS NOT NULL) WHERE n > 1),
repeated AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
counts AS (
  SELECT doc_id, source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM docs LEFT JOIN sized USING (r) LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r)),
flags AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS f_base,
         100 * n_symbols > 30 * n_words AS f_symbols, 100 * n_dup_lines > 30 * n_lines AS f_lines FROM counts),
hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (f_base) AS x_base, count(*) FILTER (f_symbols) AS x_symbols, count(*) FILTER (f_lines) AS x_lines
  FROM flags WHERE source IS NOT NULL GROUP BY source),
priors AS ({" UNION ALL ".join(map(_prior, _RULE_NAMES))}),
verdicts AS (
  SELECT source, bool_or((x + m * k) / (n + k) > 0.5) AS host_failed
  FROM (SELECT source, n, unnest(['base', 'symbols', 'lines']) AS rule, unnest([x_base, x_symbols, x_lines]) AS x FROM hosts) JOIN priors USING (rule)
  GROUP BY source)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, f_base AS base_failed,
       NOT f_base AND NOT coalesce(host_failed, false) AS kept
FROM flags LEFT JOIN verdicts USING (source)
"""

WARC = """
WITH pages2 AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, max(page_id) AS first FROM pages2 WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM pages2 LEFT JOIN firsts USING (payload_digest)
"""

NEAREST = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
one AS (SELECT vec_id, min(e) AS e FROM v GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda s, x: s + x)) AS score
  FROM one q JOIN one c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM scored) WHERE rank <= 10
"""

MINHASH = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i, count(*) OVER (PARTITION BY doc_id) AS n
  FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
        FROM (SELECT doc_id, string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') AS ws FROM documents))
  WHERE w <> ''),
windows AS (
  SELECT doc_id, i, n, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS g
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
shingles AS (SELECT DISTINCT doc_id, g FROM windows WHERE i <= greatest(n - 4, 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes a ON x = a.doc_id JOIN sizes b ON y = b.doc_id WHERE 100 * c >= 85 * (a.n + b.n - c)),
mutual AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, y FROM reach JOIN mutual ON r = x)
SELECT doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SMALL = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

RANKED = rf"""
WITH terms AS (
  SELECT d, doc_id, unnest(regexp_extract_all(translate(text, {_SMALL}), '{TERM}')) AS t
  FROM (SELECT row_number() OVER () AS d, doc_id, text FROM documents)),
tallied AS (SELECT d, any_value(doc_id) AS doc_id, t, count(*) AS tf FROM terms GROUP BY d, t),
sized AS (SELECT d, CAST(sum(tf) AS BIGINT) AS n FROM tallied GROUP BY d),
totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM sized),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM tallied GROUP BY t), totals),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, {_SMALL}), '{TERM}')) AS t FROM benchmark WHERE item_id IS NOT NULL),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nd) // nt))))) AS BIGINT) AS score
  FROM asked JOIN weights USING (t) JOIN tallied USING (t) JOIN sized USING (d), totals
  WHERE doc_id IS NOT NULL GROUP BY item_id, d, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50
"""


def _crc_table() -> list[int]:
    """What each byte does to a 32-bit cyclic checksum, from its polynomial."""
    table = list(range(256))
    for _ in range(8):
        table = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in table]
    return table


VARIANTS = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, r, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, {_SMALL}), '[a-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents) GROUP BY doc_id, r),
hexed AS (SELECT r, n, length(r) AS size, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r)) AS x FROM runs),
hashed AS (
  SELECT r, n, size, xor(list_reduce(
    list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM hexed, (SELECT CAST({_crc_table()} AS BIGINT[]) AS tab)),
dropped AS (SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, h % size) || substr(r, h % size + 2) ELSE r END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM dropped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
holes AS (SELECT word, i, substr(word, 1, i) AS front, substr(word, i + 2) AS back FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word AS x, b.word AS y FROM holes a JOIN holes b ON a.i = b.i AND a.front = b.front AND a.back = b.back AND a.word <> b.word
  UNION SELECT holes.word, words.word FROM holes JOIN words ON words.word = front || back
  UNION SELECT words.word, holes.word FROM holes JOIN words ON words.word = front || back),
best AS (
  SELECT x AS word, count(*) AS n_near, first(y ORDER BY n DESC, encode(y)) AS y, max(n) AS best_n FROM pairs JOIN words ON y = words.word GROUP BY x),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * words.n THEN y END AS form, CASE WHEN best_n >= 5 * words.n THEN best_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS place FROM forms UNION ALL SELECT walk.word, form FROM walk JOIN forms ON walk.place = forms.word WHERE form IS NOT NULL)
SELECT word, form, place AS root, n, CAST(n_near AS BIGINT) AS n_near, form_n
FROM walk JOIN (SELECT word AS last FROM forms WHERE form IS NULL) ON place = last JOIN forms USING (word)
"""

TOP_PRODUCTS = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
one AS (SELECT vec_id, min(e) AS e FROM v GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM one q JOIN one c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""

ORACLE: dict[str, str] = {
    "op3_minhash": MINHASH,
    "op1_rabitq": NEAREST,
    "op2_warc": WARC,
    "op4_host_rules": HOST_RULES,
    "op11_ball_tree": RANKED,
    "op12_gram_variants": VARIANTS,
    "op13_block_max": TOP_PRODUCTS,
}
