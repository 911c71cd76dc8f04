"""DuckDB statements of the queries that SQL can express; the others are tested against brute force in tests/llm."""

STATEMENTS: dict[str, str] = {
    "op1_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(text) AS hash,
    row_number() OVER (PARTITION BY doc_id, text) - 1 AS place FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
  FROM sized GROUP BY source
),
ranked AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
    row_number() OVER (ORDER BY source_size * 2.0::DOUBLE / weight, source IS NULL, encode(source)) AS rank FROM sources
),
levels AS (
  SELECT *, (least(sum(source_size) OVER () * 1.5::DOUBLE, sum(cap) OVER ())
      - coalesce(sum(cap) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / sum(weight) OVER (ORDER BY rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked
),
opened AS (SELECT level FROM levels WHERE level * weight < cap ORDER BY rank LIMIT 1),
targets AS (
  SELECT source, source_size, coalesce(least(cap, (SELECT level FROM opened) * weight), cap) AS target FROM levels
),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(md5('20250:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(hash, 'null') || ':' || place), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
""",
    "op6_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words
),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
  doc_id <= coalesce(b, doc_id) AS kept
FROM sizes LEFT JOIN least_of ON a = doc_id
""",
    "op9_embedding_dedup": """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.98
),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*)::BIGINT AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
  vec_id <= coalesce(b, vec_id) AS kept
FROM embeddings LEFT JOIN least_of ON least_of.a = vec_id LEFT JOIN degree ON degree.a = vec_id
""",
    "op12_merkle_manifest": r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree, text, doc_id::VARCHAR AS id,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
      || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
      || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
      || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head
  FROM documents
),
summed AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(id, ''), lambda c: ascii(c)::BIGINT)),
      lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))), 4294967295::BIGINT) AS crc
  FROM fields
),
hashed AS (
  SELECT doc_id, tree, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
    CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut, head
  FROM summed
),
leaves AS (
  SELECT doc_id, tree, leaf, sha256(head || CASE WHEN cut IS NULL THEN '-' ELSE strlen(cut) || ':' || cut END) AS tried,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM hashed
),
nodes(tree, level, pos, n, digest) AS (
  SELECT tree, 0, pos, n, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 3, n
),
subroots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS top_pos, count(*) OVER () AS top_n FROM nodes WHERE n = 1
),
tops(level, pos, n, digest) AS (
  SELECT 0, top_pos, top_n, subroot FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 3, n
),
runs AS (
  SELECT tree, level, pos // 3 AS run, list(digest ORDER BY pos) AS members FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 3
),
top_runs AS (SELECT level, pos // 3 AS run, list(digest ORDER BY pos) AS members FROM tops WHERE n > 1 GROUP BY level, pos // 3),
walk(doc_id, tree, leaf, level, pos, n, proof, folded) AS (
  SELECT doc_id, tree, leaf, 0, pos, n, '', tried FROM leaves
  UNION ALL
  SELECT doc_id, w.tree, leaf, w.level + 1, pos // 3, (n + 2) // 3,
    proof || array_to_string(members[1:pos % 3], '') || array_to_string(members[pos % 3 + 2:], ''),
    sha256(array_to_string(members[1:pos % 3], '') || folded || array_to_string(members[pos % 3 + 2:], ''))
  FROM walk w JOIN runs r ON r.tree = w.tree AND r.level = w.level AND r.run = w.pos // 3 WHERE n > 1
),
climb(doc_id, leaf, subroot, level, pos, n, proof, folded) AS (
  SELECT doc_id, leaf, subroot, 0, top_pos, top_n, proof, folded FROM walk JOIN subroots USING (tree) WHERE n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, c.level + 1, pos // 3, (n + 2) // 3,
    proof || array_to_string(members[1:pos % 3], '') || array_to_string(members[pos % 3 + 2:], ''),
    sha256(array_to_string(members[1:pos % 3], '') || folded || array_to_string(members[pos % 3 + 2:], ''))
  FROM climb c JOIN top_runs r ON r.level = c.level AND r.run = c.pos // 3 WHERE n > 1
)
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM climb, (SELECT digest FROM tops WHERE n = 1) WHERE n = 1
""",
    "op13_lexical_search": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL
),
docs AS (SELECT doc_id, w, len(w)::BIGINT AS size FROM words WHERE len(w) > 0),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(size)::BIGINT AS n_terms FROM docs),
found AS (SELECT doc_id, size, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, size, unnest(w) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM found, corpus GROUP BY term, n_docs
),
impacts AS (
  SELECT doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * size * n_docs) // n_terms))) AS impact
  FROM found JOIN weights USING (term), corpus
),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL
),
scored AS (SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
""",
}
