"""SQL for the queries that SQL can express."""

from __future__ import annotations

from siftworks.llm.chat_format import CONTROLS

# Every control string and every backslash grows by one character when escaped.
_GROWTH = " + ".join(["length(text) - length(replace(text, '\\', ''))"]
                     + [f"(length(text) - length(replace(text, '{c}', ''))) // {len(c)}" for c in CONTROLS])

CHAT = f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (SELECT *, length(text) + {_GROWTH} + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 ELSE 24 + length(role) END AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(chars))::BIGINT AS formatted_chars, false AS rewritten
FROM sized GROUP BY conv_id"""

WARC = """
WITH d AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex FROM d),
b AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(hex, 5 * (k // 4) + 1, 5))::INTEGER >> (15 - 5 * (k % 4))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest FROM h),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to, true AS verified
FROM f"""

NGRAM_JOIN = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
             ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS grams FROM w),
n AS (SELECT doc_id, len(grams) AS size FROM s),
g AS (SELECT doc_id, unnest(grams) AS gram FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b USING (gram) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.size + y.size - shared)),
e AS (SELECT a AS u, b AS v FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS u, doc_id AS c FROM n UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.u),
k AS (SELECT u, count(*) AS links FROM e GROUP BY u)
SELECT n.doc_id, any_value(n.size)::BIGINT AS n_shingles, min(r.c) AS component_id, coalesce(any_value(k.links), 0)::BIGINT AS n_links
FROM n JOIN r ON r.u = n.doc_id LEFT JOIN k ON k.u = n.doc_id GROUP BY n.doc_id"""

# Bytes as pairs of hexadecimal digits; a run goes on while repeated strings overlap or touch.
SUFFIX_REPEATS = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT r, i, md5(substr(x, 2 * i + 1, 400)) AS h FROM (SELECT r, x, unnest(range(0, n - 199)) AS i FROM d)),
g AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS c FROM w) WHERE c > 1),
s AS (SELECT r, i, sum(CASE WHEN i - before <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS run
      FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM g)),
v AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM s GROUP BY r, run),
k AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z FROM v),
t AS (SELECT r, sum(b - a) AS gone, count(*) AS spans, string_agg(substr(x, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS left_over
      FROM k JOIN d USING (r) GROUP BY r)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(left_over, x))) AS kept_sha256
FROM d LEFT JOIN t USING (r)"""

COLLOCATIONS = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
m AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 6) t(k))),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT lang, phrase, k, f AS a, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
s AS (SELECT c.lang, c.phrase, c.k, a, cut, x.f AS l, y.f AS r, n, (1000 * a * n) // (x.f * y.f) AS score FROM c JOIN m USING (lang)
      JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
o AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM f z WHERE z.lang = b.lang AND z.k > b.k AND 100 * z.f >= 100 * b.a AND contains(' ' || z.phrase || ' ', ' ' || b.phrase || ' '))),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM q WHERE rank <= 2000"""

# DuckDB has no crc32; its table of 256 entries follows from the polynomial.
PREFIX_TRIE = """
WITH RECURSIVE e AS (SELECT i::BIGINT AS i, i::BIGINT AS v, 0 AS k FROM range(256) t(i)
                     UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM e WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM e WHERE k = 8),
t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p,
             {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list(x ORDER BY p) AS xs FROM t GROUP BY c),
h AS (SELECT c, xs, c - c % 5 AS b,
             (xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda y: ascii(y)::BIGINT)),
                              lambda a, y: xor(a >> 8, t[xor(a & 255, y) + 1])), 4294967295) % 9)::BIGINT AS h FROM o, crc),
r AS (SELECT h.c, list_concat(coalesce(g.xs, [])[:h.h], h.xs[h.h + 1:]) AS xs FROM h LEFT JOIN o g ON g.c = h.b),
w AS (SELECT c, len(xs) AS n, unnest(range(0, len(xs) + 1)) AS depth, xs FROM r),
m AS (SELECT c, depth, n, CASE WHEN depth = 0 THEN [] ELSE xs[:depth] END AS node, CASE WHEN depth < 2 THEN [] ELSE xs[:depth - 1] END AS up,
             CASE WHEN depth = 0 THEN 0 ELSE strlen(xs[depth].text) END AS bytes FROM w),
v AS (SELECT depth, node, min(c) AS conv_id, count(*) AS n_convs, any_value(up) AS up, any_value(bytes) AS bytes,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = depth), '')) AS ends_sha256 FROM m GROUP BY depth, node),
a AS (SELECT v.*, u.conv_id AS parent_conv_id FROM v LEFT JOIN v u ON u.depth = v.depth - 1 AND u.node = v.up),
k AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY ALL),
f AS (SELECT a.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * bytes AS saves FROM a LEFT JOIN k USING (depth, node)),
s AS (SELECT f.depth, f.conv_id, sum(CASE WHEN z.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(z.saves) AS saved_tokens
      FROM f JOIN f z ON z.depth >= f.depth AND (f.depth = 0 OR z.node[:f.depth] = f.node) GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM f JOIN s USING (depth, conv_id)"""
