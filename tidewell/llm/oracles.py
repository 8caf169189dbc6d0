"""DuckDB SQL for the queries that SQL can express."""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, position, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS position FROM documents)
), shared AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT doc_id, position, line, key IN (SELECT key FROM shared) AS gone FROM lines
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# Buckets by recursion over the bits, where the operator rolls up histograms.
SHARDING = """
WITH RECURSIVE hashed AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS size,
         md5(coalesce('i' || doc_id::VARCHAR, 'n') || ':' || coalesce(md5(text), 'n'))[1:16] AS digits FROM documents
), bitted AS (
  SELECT doc_id, size, string_agg(lpad(bin(('0x' || digits[i:i])::INT)::VARCHAR, 4, '0'), '' ORDER BY i) AS bits
  FROM hashed, range(1, 17) AS r(i) GROUP BY doc_id, size
), walk AS (
  SELECT doc_id, size, bits, 0 AS depth, '' AS shard, sum(size) OVER () AS shard_bytes,
         count(*) OVER () AS shard_docs FROM bitted
  UNION ALL
  SELECT doc_id, size, bits, depth + 1, bits[1:depth + 1],
         sum(size) OVER (PARTITION BY bits[1:depth + 1]), count(*) OVER (PARTITION BY bits[1:depth + 1])
  FROM walk WHERE shard_bytes > 33554432 AND depth < 64
)
SELECT doc_id, size, shard, depth::INT AS depth, shard_bytes::BIGINT AS shard_bytes, shard_docs,
       shard_bytes <= 33554432 AS fits
FROM walk WHERE shard_bytes <= 33554432 OR depth = 64
"""

# Windows as joined words, where the operator intersects postings.
DECONTAMINATION = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
  FROM (SELECT item_id, words, least(10, len(words)) AS size,
               unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
        FROM item_words WHERE len(words) > 0)
), doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), grams AS (
  SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM doc_words, (SELECT DISTINCT size FROM windows))
), hits AS (
  SELECT g.doc_id, g.i, g.size, w.item_id FROM grams g JOIN windows w USING (size, phrase)
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

# Prefixes as hash chains over all depths; crc32 bit by bit, as SQL has none.
PREFIX_TRIE = """
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
         coalesce(role, '') AS role, coalesce(text, '') AS txt FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda state, byte: list_reduce([xor(state, byte)] || [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[],
      lambda r, step: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::BIGINT) ELSE r // 2 END)), 4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
  SELECT v.c, t.i, t.role, t.txt FROM convs v JOIN turns t ON t.c = v.c - v.c % 5 AND t.i <= v.h
  UNION ALL
  SELECT v.c, 1000000 + t.i, t.role, t.txt FROM convs v JOIN turns t ON t.c = v.c AND t.i > v.h
), placed AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY i) AS depth, strlen(txt) AS bytes,
         sha256(len(role)::VARCHAR || ':' || role || txt) AS known FROM rebuilt
), prefixes AS (
  SELECT c, depth, bytes, sha256(string_agg(known, '') OVER (PARTITION BY c ORDER BY depth)) AS node,
         sha256(string_agg(known, '') OVER (PARTITION BY c ORDER BY depth
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS up FROM placed
  UNION ALL
  SELECT c, 0, 0, 'root', NULL FROM convs
), sizes AS (
  SELECT c, max(depth) AS turns FROM prefixes GROUP BY c
), nodes AS (
  SELECT node, depth, any_value(CASE WHEN depth = 1 THEN 'root' ELSE up END) AS up, any_value(bytes) AS bytes,
         min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (depth = turns), '')) AS ends_sha256
  FROM prefixes JOIN sizes USING (c) GROUP BY node, depth
), children AS (
  SELECT up AS node, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up
), whole AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * bytes AS spared
  FROM nodes n LEFT JOIN children USING (node)
), ancestors AS (
  SELECT DISTINCT a.node AS node, d.node AS below
  FROM prefixes d JOIN prefixes a ON a.c = d.c AND a.depth <= d.depth
), subtrees AS (
  SELECT a.node, count(*) FILTER (w.n_children = 0) AS n_leaves, sum(w.spared)::BIGINT AS saved_tokens
  FROM ancestors a JOIN whole w ON w.node = a.below GROUP BY a.node
)
SELECT w.conv_id, w.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves,
       s.saved_tokens, w.ends_sha256
FROM whole w JOIN subtrees s USING (node) LEFT JOIN whole p ON p.node = w.up
"""

# All phrases of all lengths, where the operator goes up level by level.
COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words FROM documents
), phrases AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM pieces, range(1, 6) AS lengths(k))
), f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f FROM phrases GROUP BY lang, k, phrase HAVING count(*) >= 100
), totals AS (
  SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k >= 2
), cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, n,
         ((1000::HUGEINT * c.a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT lang, phrase, a, cut, array_to_string(words[1:cut], ' ') AS first,
               array_to_string(words[cut + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)) c
  JOIN f l ON l.lang = c.lang AND l.phrase = first
  JOIN f r ON r.lang = c.lang AND r.phrase = rest
  JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, a AS f, array_to_string(words[i:i + size - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS size FROM candidates)))
  GROUP BY lang, phrase
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000
"""

LLM_ORACLES = {
    "op3_line_dedup": LINE_DEDUP,
    "op8_exact_dedup": EXACT_DEDUP,
    "op9_sharding": SHARDING,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_collocations": COLLOCATIONS,
    "op13_decontamination": DECONTAMINATION,
}
