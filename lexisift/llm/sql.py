"""The same results in DuckDB SQL, where SQL can express them."""

NEAR_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- equal sets first, so that copies are not paired with each other
t AS (SELECT doc_id, string_agg(shingle, chr(10) ORDER BY shingle) AS whole FROM s GROUP BY doc_id),
c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY whole) AS rep FROM t),
r AS (SELECT s.* FROM s JOIN c USING (doc_id) WHERE c.doc_id = c.rep),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM r a JOIN r b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
links AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (
  SELECT DISTINCT rep AS doc_id, rep AS other FROM c
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
best AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(best.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(best.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN best ON best.doc_id = c.rep
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, embedding, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM (SELECT DISTINCT vec_id, v FROM v JOIN (SELECT vec_id, min(embedding) AS embedding FROM v GROUP BY vec_id) USING (vec_id, embedding)
        WHERE vec_id % 100 = 0) q
  JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""

CONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
i AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + 9], ' ') AS piece
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM b WHERE len(words) > 0)),
g AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS piece
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM i) WHERE len(words) >= n)),
h AS (SELECT g.doc_id, g.i, g.n, i.item_id FROM g JOIN i USING (n, piece)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# CRC-32 of ASCII text, bit by bit; ``{0}`` is the text.
CRC32 = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::UBIGINT)),
  lambda r, b: list_reduce(list_prepend(xor(r, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda v, z: xor(v >> 1, 3988292384::UBIGINT * (v & 1)))), 4294967295::UBIGINT)"""

PREFIX_TRIE = r"""
WITH k AS (
  SELECT conv_id, turn, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))[:32] AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS pos FROM k),
c AS (SELECT conv_id, CRC % 4 AS h FROM (SELECT DISTINCT conv_id FROM k)),
r AS (
  SELECT c.conv_id, 0 AS part, pos, key, words FROM c JOIN p ON p.conv_id = c.conv_id - c.conv_id % 20 AND pos <= h
  UNION ALL
  SELECT conv_id, 1, pos, key, words FROM c JOIN p USING (conv_id) WHERE pos > h),
f AS (
  SELECT conv_id, row_number() OVER o AS depth, string_agg(key, '') OVER o AS path, words
  FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
n AS (
  SELECT path, any_value(depth) AS depth, path[:length(path) - 32] AS parent, min(conv_id) AS conv_id,
         count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved FROM f GROUP BY path),
kids AS (SELECT parent AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY parent),
x AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (path)),
t AS (
  SELECT path, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT path[:32 * unnest(range(0, depth + 1))] AS path, (n_children = 0)::INTEGER AS leaf, saved FROM x) GROUP BY path),
e AS (
  SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(path, depth) AS path FROM f GROUP BY conv_id) GROUP BY path)
SELECT x.conv_id, x.depth, u.conv_id AS parent_conv_id, x.n_convs, x.n_children, t.n_leaves, t.saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM x JOIN t USING (path) LEFT JOIN n u ON x.depth > 0 AND u.path = x.parent LEFT JOIN e ON e.path = x.path
""".replace("CRC", CRC32.format("conv_id::VARCHAR"))

CAPTURES = r"""
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p),
t AS (SELECT *, payload_bytes >= 100 AND page_id IS DISTINCT FROM first AS again FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to, replace(url, ' ', '%20') AS url FROM t
"""
