"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_CONTROL = r"(\\|<s>|</s>|\[INST\]|\[/INST\]|\[SYS\]|\[/SYS\]|\[ROLE\]|\[/ROLE\]|\[/TURN\])"
_WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, regexp_replace(text, '{_CONTROL}', '\\\1', 'g') AS t, regexp_replace(role, '{_CONTROL}', '\\\1', 'g') AS r FROM c
), p AS (
  SELECT *, CASE role WHEN 'user' THEN '[INST] ' || t || ' [/INST]' WHEN 'assistant' THEN ' ' || t || ' </s>'
            WHEN 'system' THEN '[SYS] ' || t || ' [/SYS]' ELSE '[ROLE]' || r || '[/ROLE]' || t || '[/TURN]' END AS piece FROM e
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, piece)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, piece) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(length(piece)) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
"""

_COUNT = "len(regexp_extract_all({0}, '{1}'))"

OP2 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '{_WORD}') AS words, string_split(text, chr(10)) AS lines FROM d
), l AS (
  SELECT r, doc_id, text, words, list_filter(lines, lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM w
), a AS (
  SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i FROM l
), win AS (
  SELECT r, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS five
  FROM a WINDOW o AS (PARTITION BY r ORDER BY i)
), twice AS (
  SELECT r, i FROM win WHERE five IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, five) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(5)) AS k) GROUP BY r
), n AS (
  SELECT l.r, doc_id, text, lines, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7f]'))) AS with_letter
  FROM l LEFT JOIN covered ON covered.r = l.r
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM n
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_dup_lines > 3 * len(lines)
            OR (len(regexp_extract_all(text, '[A-Za-z]')) >= 20 AND 2 * len(regexp_extract_all(text, '[A-Z]')) > len(regexp_extract_all(text, '[A-Za-z]')))
            OR 10 * len(regexp_extract_all(text, '!')) > n_words OR 10 * with_letter < 6 * n_words
            OR 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09\x0B-\x0D]*[-*]'))) > 9 * len(lines)
            OR 10 * len(list_filter(lines, lambda x: regexp_matches(x, '\.\.\.[\x20\x09\x0B-\x0D]*$'))) > 3 * len(lines)) AS kept
FROM b
"""

OP8 = """
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS hex, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), f AS (
  SELECT hex, min(page_id) AS first_id FROM p GROUP BY hex
), bits AS (
  SELECT page_id, n, first_id, array_to_string(list_transform(range(40), lambda i: lpad(bin(strpos('0123456789abcdef', substr(hex, i + 1, 1)) - 1), 4, '0')), '') AS b
  FROM p JOIN f USING (hex)
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         list_sum(list_transform(range(5), lambda j: CAST(substr(b, CAST(5 * i + j + 1 AS BIGINT), 1) AS BIGINT) * (16 >> j)))::BIGINT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM bits
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _runs(table: str) -> str:
    return f"SELECT row_number() OVER () AS r, *, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_LETTERS}') AS ws FROM {table}"


OP12 = rf"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), d AS ({_runs('documents')}), m AS ({_runs('benchmark')}
), dw AS (
  SELECT r, unnest(ws) AS w FROM d
), mw AS (
  SELECT unnest(ws) AS w FROM m
), vocabulary AS (
  SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM mw) u
), bytes AS (
  SELECT w, list_transform(range(len(h) // 2), lambda i: CAST(16 * (strpos('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1)
                                                              + strpos('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1 AS BIGINT)) AS b FROM vocabulary
), hashed AS (
  SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes CROSS JOIN crc
), s AS (
  SELECT bucket, count(*) AS n FROM dw JOIN hashed USING (w) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS n FROM mw JOIN hashed USING (w) GROUP BY bucket
), totals AS (
  SELECT CAST((SELECT count(*) FROM dw) AS DOUBLE) AS s, CAST((SELECT count(*) FROM mw) AS DOUBLE) AS t
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * (totals.s + 10000) / ((s.n + 1.0::DOUBLE) * (totals.t + 10000)))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (bucket) CROSS JOIN totals
), weight AS (
  SELECT r, sum(g) AS weight FROM dw JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY r
), hx AS (
  SELECT r, doc_id, len(ws) AS n, coalesce(weight.weight, 0) AS weight, substr(sha256('2024:' || doc_id), 1, 8) AS x FROM d LEFT JOIN weight USING (r)
), scored AS (
  SELECT r, doc_id, n, weight, weight + CAST(floor(-1000 * ln(-ln((list_reduce(list_transform(range(8),
           lambda i: CAST(strpos('0123456789abcdef', substr(x, i + 1, 1)) - 1 AS BIGINT)), lambda a, b: 16 * a + b) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM hx
), placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, weight, n) AS place, count(*) OVER () AS fit FROM scored WHERE n >= 20
)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN place <= 10 * fit // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (r)
"""


def _op13(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'distance': distance, 'c': c}}) AS near
  FROM (SELECT q.r, q.vec_id, q.v, c.c, list_sum(list_transform(range(1, {dims + 1}), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i]))) AS distance
        FROM q CROSS JOIN c{i} c) x GROUP BY r
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS (
  SELECT old.c, coalesce(new.v, old.v) AS v FROM c{i} old LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v
    FROM (SELECT near.c AS c, i, sum(v[i]) AS s, count(*) AS n FROM a{i} CROSS JOIN range(1, {dims + 1}) t(i) GROUP BY near.c, i) y GROUP BY c
  ) new ON old.c = new.c
)""")
    return f"""
WITH q AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({dims} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM q QUALIFY c < {k}
), {', '.join(steps)}
SELECT a.vec_id, CAST(near.c AS INTEGER) AS cluster, CAST(near.distance AS BIGINT) AS distance,
       CAST(sum(near.distance) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia, CAST(sum(near.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.near.c = c.c
"""


OP13 = _op13()

ORACLE = {"op1_chat_format": OP1, "op2_quality_rules": OP2, "op8_warc": OP8, "op12_resample": OP12, "op13_centroids": OP13}
