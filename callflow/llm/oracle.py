"""DuckDB SQL of the queries that SQL can express, on the same tables."""

WORD = r"[^\x20\x09-\x0D]+"

OP3 = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), cut AS (
  SELECT *, regexp_extract_all(t, '{WORD}') AS ws, string_split(t, chr(10)) AS ls FROM texts
), triples AS (
  SELECT r, i, hash(ws[i]) AS a, hash(ws[i + 1]) AS b, hash(ws[i + 2]) AS c
  FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM cut WHERE len(ws) > 2)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM triples) WHERE n > 1
), repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), based AS (
  SELECT cut.r, doc_id, t, ws, ls, len(ws) AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(list_filter(ls, lambda x: regexp_matches(x, '{WORD}')))
      - len(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '{WORD}')))))::BIGINT AS n_dup_lines,
    coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM cut LEFT JOIN repeated ON cut.r = repeated.r
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    len(list_distinct(ws)) AS n_distinct,
    len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_cut,
    len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*([-*] |•)'))) AS n_bullets
  FROM based
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 10 * n_symbols > n_words
    OR (n_dup_lines >= 4 AND 10 * n_dup_lines > 3 * len(ls))
    OR 100 * n_repeat_words > 30 * n_words
    OR 10 * len(list_filter(ws, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) < 6 * n_words
    OR 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 40 * word_chars
    OR 2 * (length(t) - length(regexp_replace(t, '[!?]', '', 'g'))) > n_words
    OR (n_words > 100 AND n_distinct <= 50 AND 100 * n_distinct < 3 * n_words)
    OR (n_cut >= 3 AND 10 * n_cut > 3 * len(ls))
    OR (n_bullets >= 3 AND 10 * n_bullets > 9 * len(ls))) AS kept
FROM judged
"""

OP2 = rf"""
WITH RECURSIVE cut AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents
), shingles AS (
  SELECT DISTINCT r, array_to_string(ws[i : i + 4], ' ') AS s
  FROM (SELECT r, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM cut WHERE len(ws) > 0)
), sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
  SELECT a.r AS x, b.r AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes a ON a.r = x JOIN sizes b ON b.r = y
  WHERE common.n >= 0.8 * (a.n + b.n - common.n) - 1e-9
), reach(r, o) AS (
  SELECT r, r FROM cut UNION SELECT reach.r, links.y FROM reach JOIN links ON links.x = reach.o
), classes AS (
  SELECT reach.r, min(d.doc_id) AS class_id FROM reach JOIN cut d ON d.r = reach.o GROUP BY reach.r
), degrees AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT doc_id, class_id, coalesce(n, 0)::BIGINT AS n_links, doc_id = class_id AS kept
FROM cut JOIN classes ON classes.r = cut.r LEFT JOIN degrees ON degrees.x = cut.r
"""

OP10 = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm
  FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_dot_product(a.v, b.v) >= 0.95 * a.norm * b.norm
), reach(v, o) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.v, links.y FROM reach JOIN links ON links.x = reach.o
), components AS (SELECT v, min(o) AS component_id FROM reach GROUP BY v),
degrees AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN components ON v = vec_id LEFT JOIN degrees ON x = vec_id
"""

OP12 = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text,
    list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
  FROM documents
), fields AS (
  SELECT r, doc_id, source, crc, text,
    list_aggregate(list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR],
      lambda v: coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '') AS head
  FROM docs
), hashed AS (
  SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed, head
  FROM fields
), leaves AS (
  SELECT r, doc_id, source, leaf, sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS other,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM hashed
), nodes(source, level, pos, n, digest) AS (
  SELECT source, 0, pos, n, leaf FROM leaves
  UNION ALL
  SELECT source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1
  GROUP BY source, level, pos // 3, n
), subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), tops(level, pos, n, digest) AS (
  SELECT 0, pos, n, subroot FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1
  GROUP BY level, pos // 3, n
), runs AS (
  SELECT source, level, pos // 3 AS up, string_agg(digest, '' ORDER BY pos) AS digests FROM nodes WHERE n > 1
  GROUP BY source, level, pos // 3
), top_runs AS (
  SELECT level, pos // 3 AS up, string_agg(digest, '' ORDER BY pos) AS digests FROM tops WHERE n > 1 GROUP BY level, pos // 3
), climb(r, source, level, pos, n, others, digest) AS (
  SELECT r, source, 0, pos, n, '', other FROM leaves
  UNION ALL
  SELECT r, c.source, c.level + 1, pos // 3, (n + 2) // 3,
    others || digests[: pos % 3 * 64] || digests[pos % 3 * 64 + 65 :],
    sha256(digests[: pos % 3 * 64] || digest || digests[pos % 3 * 64 + 65 :])
  FROM climb c JOIN runs ON runs.source IS NOT DISTINCT FROM c.source AND runs.level = c.level AND up = pos // 3
  WHERE n > 1
), over(r, level, pos, n, others, digest) AS (
  SELECT r, 0, s.pos, s.n, others, digest FROM climb c JOIN subroots s ON s.source IS NOT DISTINCT FROM c.source
  WHERE c.n = 1
  UNION ALL
  SELECT r, o.level + 1, pos // 3, (n + 2) // 3,
    others || digests[: pos % 3 * 64] || digests[pos % 3 * 64 + 65 :],
    sha256(digests[: pos % 3 * 64] || digest || digests[pos % 3 * 64 + 65 :])
  FROM over o JOIN top_runs ON top_runs.level = o.level AND up = pos // 3 WHERE n > 1
)
SELECT doc_id, leaf, subroot, root.digest AS root, sha256(others) AS proof_sha256, o.digest AS folded_root,
  o.digest = root.digest AS verified
FROM leaves JOIN over o ON o.r = leaves.r AND o.n = 1
JOIN subroots ON subroots.source IS NOT DISTINCT FROM leaves.source, (SELECT digest FROM tops WHERE n = 1) root
"""

OP13 = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[:32] AS unit, turn
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, unit) AS d FROM turns
), heads AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own)
), joined AS (
  SELECT heads.conv_id, unit, length(text) AS tokens, 0 AS side, d FROM heads JOIN own ON own.conv_id = base AND d <= h
  UNION ALL
  SELECT heads.conv_id, unit, length(text), 1, d FROM heads JOIN own ON own.conv_id = heads.conv_id AND d > h
), rebuilt AS (
  SELECT conv_id, tokens, row_number() OVER w AS depth, sha256(string_agg(unit, '') OVER w) AS node
  FROM joined WINDOW w AS (PARTITION BY conv_id ORDER BY side, d)
), members AS (
  SELECT conv_id, depth, tokens, node, lag(node, 1, 'root') OVER (PARTITION BY conv_id ORDER BY depth) AS up FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, 'root', NULL FROM heads
), ends AS (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id),
nodes AS (
  SELECT node, m.depth, min(up) AS up, min(m.conv_id) AS conv_id, count(*) AS n_convs, min(tokens) AS tokens,
    sha256(coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (WHERE e.depth = m.depth), '')) AS ends
  FROM members m JOIN ends e ON e.conv_id = m.conv_id GROUP BY node, m.depth
), children AS (SELECT up, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
valued AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children, (n_convs - 1) * tokens AS saved
  FROM nodes LEFT JOIN children ON children.up = nodes.node
), sums AS (
  SELECT m.node, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens
  FROM valued v JOIN members m ON m.conv_id = v.conv_id AND m.depth <= v.depth GROUP BY m.node
)
SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs,
  v.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
  v.ends AS ends_sha256
FROM valued v JOIN sums ON sums.node = v.node LEFT JOIN nodes p ON p.node = v.up
"""

ALL = {"op2_jaccard_join": OP2, "op3_quality": OP3, "op10_embedding_links": OP10, "op12_merkle_manifest": OP12,
       "op13_prefix_trie": OP13}
