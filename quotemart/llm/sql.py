"""SQL for the training-data queries, stated on its own; DuckDB runs it over the given tables."""

from __future__ import annotations

DECONTAMINATION = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), win AS (
    SELECT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS phrase
    FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM b WHERE len(w) > 0)
), seen AS (
    SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS phrase
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
), m AS (
    SELECT DISTINCT r, p, n, item_id FROM seen JOIN win USING (n, phrase)
), hit AS (
    SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM m) GROUP BY r
), ids AS (
    SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (WHERE item_id IS NOT NULL)) AS items FROM m GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""

ARCHIVES = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS raw FROM pages
), q AS (
    SELECT page_id, CAST(octet_length(raw) AS BIGINT) AS payload_bytes, sha1(raw) AS payload_digest FROM p
), g AS (
    SELECT payload_digest, payload_bytes, max(page_id) AS kept FROM q WHERE payload_bytes >= 1000 GROUP BY ALL
)
SELECT q.page_id, q.payload_bytes, q.payload_digest,
       CASE WHEN g.kept IS NULL OR g.kept = q.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.kept <> q.page_id THEN g.kept END AS refers_to
FROM q LEFT JOIN g USING (payload_digest, payload_bytes)
"""

JACCARD = r"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS MATERIALIZED (
    SELECT DISTINCT r, array_to_string(w[p:p + 4], ' ') AS shingle
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)
), n AS MATERIALIZED (
    SELECT r, count(*) AS n FROM s GROUP BY r
), common AS (
    SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY ALL
), link AS MATERIALIZED (
    SELECT a, b FROM common JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach AS (
    SELECT r AS a, r AS b FROM d
    UNION
    SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM d JOIN reach ON reach.a = d.r JOIN d o ON o.r = reach.b LEFT JOIN n ON n.r = d.r
GROUP BY d.r, d.doc_id
"""

MANIFEST = r"""
WITH RECURSIVE f AS (
    SELECT doc_id, source,
           concat(coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-'),
                  coalesce(octet_length(encode(source)) || ':' || source, '-'),
                  coalesce(octet_length(encode(lang)) || ':' || lang, '-'),
                  coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-')) AS head,
           text,
           list_reduce([4294967295] || list_transform(list_filter(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: c <> ''), lambda c: CAST(ord(c) AS BIGINT)),
                       lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                                lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
    FROM documents
), leaf AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r
    FROM (SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
                 sha256(head || coalesce(octet_length(encode(other)) || ':' || other, '-')) AS other
          FROM (SELECT *, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM f))
), tree AS (
    SELECT source, 0 AS h, list(leaf ORDER BY r) AS nodes FROM leaf GROUP BY source
    UNION ALL
    SELECT source, h + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], '')))
    FROM tree WHERE len(nodes) > 1
), sub AS MATERIALIZED (
    SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r FROM tree WHERE len(nodes) = 1
), top AS (
    SELECT 0 AS h, list(subroot ORDER BY r) AS nodes FROM sub
    UNION ALL
    SELECT h + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], ''))) FROM top WHERE len(nodes) > 1
), step AS (
    SELECT leaf.source, leaf.r, h, nodes, CAST(floor(leaf.r / pow(3, h)) AS BIGINT) AS i
    FROM leaf JOIN tree ON tree.source IS NOT DISTINCT FROM leaf.source WHERE len(nodes) > 1
    UNION ALL
    SELECT leaf.source, leaf.r, 100 + h, nodes, CAST(floor(sub.r / pow(3, h)) AS BIGINT)
    FROM leaf JOIN sub ON sub.source IS NOT DISTINCT FROM leaf.source, top WHERE len(nodes) > 1
), path AS (
    SELECT source, r, list(array_to_string(nodes[i - i % 3 + 1:i], '') || '|' || array_to_string(nodes[i + 2:i - i % 3 + 3], '') ORDER BY h) AS steps
    FROM step GROUP BY source, r
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(coalesce(steps, []), ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM (
    SELECT leaf.*, subroot, steps, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root,
           list_reduce([other] || coalesce(steps, []), lambda d, s: sha256(split_part(s, '|', 1) || d || split_part(s, '|', 2))) AS folded_root
    FROM leaf JOIN sub ON sub.source IS NOT DISTINCT FROM leaf.source
    LEFT JOIN path ON path.source IS NOT DISTINCT FROM leaf.source AND path.r = leaf.r
)
"""

DIVERGENCE = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), groups AS MATERIALIZED (
    SELECT DISTINCT lang, source FROM d
), t AS MATERIALIZED (
    SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL
), kept AS MATERIALIZED (
    SELECT lang, term, sum(n) AS n FROM t GROUP BY lang, term HAVING sum(docs) >= 3
), l AS MATERIALIZED (
    SELECT lang, count(*) AS v, sum(n) AS words FROM kept GROUP BY lang
), g AS MATERIALIZED (
    SELECT lang, source, coalesce(sum(t.n), 0) AS words
    FROM groups LEFT JOIN (t JOIN kept USING (lang, term)) AS t USING (lang, source) GROUP BY lang, source
), p AS MATERIALIZED (
    SELECT lang, source, term, coalesce(t.n, 0) AS n,
           CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(t.n, 0) + 1) // (g.words + l.v) AS HUGEINT) AS p,
           CAST(1 + CAST(1000000000 AS HUGEINT) * (kept.n + 1) // (l.words + l.v) AS HUGEINT) AS q
    FROM g JOIN l USING (lang) JOIN kept USING (lang) LEFT JOIN t USING (lang, source, term)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
), above AS (
    SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM (SELECT * FROM every UNION ALL SELECT * FROM above)
QUALIFY part = 'pair' OR rank <= 200
"""
