"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH RECURSIVE msgs AS (
  SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
),
mail AS (
  SELECT *, CASE WHEN turn % 3 = 2 THEN turn - 2 ELSE turn - 1 END AS one FROM msgs
),
quoted AS (
  SELECT m.conv_id, m.turn, 1 AS level, o.text
  FROM mail m JOIN msgs o ON o.conv_id = m.conv_id AND o.turn = m.one
  UNION ALL
  SELECT m.conv_id, m.turn, 2, o.text
  FROM mail m JOIN msgs o ON o.conv_id = m.conv_id
    AND o.turn = CASE WHEN m.one % 3 = 2 THEN m.one - 2 ELSE m.one - 1 END
),
quoted_forms AS (
  SELECT conv_id, turn, level, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS form FROM quoted
),
parts AS (
  SELECT conv_id, turn, text AS part FROM msgs
  UNION ALL SELECT conv_id, turn, unnest(regexp_split_to_array(text, '\n[ \t]*\n')) FROM msgs
  UNION ALL SELECT conv_id, turn, unnest(string_split(text, chr(10))) FROM msgs
),
holders AS (
  SELECT DISTINCT conv_id, turn, form
  FROM (SELECT conv_id, turn, lower(trim(regexp_replace(part, '\s+', ' ', 'g'))) AS form FROM parts)
  WHERE form <> ''
),
sources AS (
  SELECT q.conv_id, q.turn, q.level, q.form, max(h.turn) AS source
  FROM quoted_forms q JOIN holders h ON h.conv_id = q.conv_id AND h.form = q.form AND h.turn < q.turn
  GROUP BY ALL
),
best AS (
  SELECT conv_id, turn, level, source,
         row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, source DESC) AS k
  FROM sources
),
links AS (
  SELECT m.conv_id, m.turn, b.source AS parent_turn, b.level AS quote_level
  FROM msgs m LEFT JOIN best b ON b.conv_id = m.conv_id AND b.turn = m.turn AND b.k = 1
),
walk AS (
  SELECT conv_id, turn, turn AS thread_turn, 0::BIGINT AS depth FROM links WHERE parent_turn IS NULL
  UNION ALL
  SELECT l.conv_id, l.turn, w.thread_turn, w.depth + 1
  FROM walk w JOIN links l ON l.conv_id = w.conv_id AND l.parent_turn = w.turn
)
SELECT m.conv_id,
       row_number() OVER (PARTITION BY m.conv_id ORDER BY w.thread_turn, m.turn) - 1 AS position,
       m.turn, m.role, trim(m.text, ' ' || chr(9) || chr(10) || chr(13)) AS text, l.parent_turn, l.quote_level, w.thread_turn, w.depth
FROM msgs m
JOIN links l ON l.conv_id = m.conv_id AND l.turn = m.turn
JOIN walk w ON w.conv_id = m.conv_id AND w.turn = m.turn
"""

OP2 = r"""
WITH tree AS (
  SELECT range AS shard, range // 8 AS region, range % 8 // 4 AS rack FROM range(40)
),
nodes AS (
  SELECT 1 AS level, '' AS above, 'g' || region AS name, '/g' || region AS path, count(*)::DOUBLE AS weight, NULL::INT AS shard
  FROM tree GROUP BY region
  UNION ALL
  SELECT 2, '/g' || region, 'k' || rack, '/g' || region || '/k' || rack, count(*)::DOUBLE, NULL FROM tree GROUP BY region, rack
  UNION ALL
  SELECT 3, '/g' || region || '/k' || rack, shard::VARCHAR, '/g' || region || '/k' || rack || '/' || shard, 1.0, shard FROM tree
),
keys AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 16 AS size, coalesce('k' || doc_id, 'null') AS k FROM documents
),
draws AS (
  SELECT level, above, path, shard, weight, k, doc_id, size,
         -ln((('0x' || substr(md5(k || path), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / weight AS draw
  FROM keys, nodes
),
won AS (
  SELECT * FROM draws QUALIFY row_number() OVER (PARTITION BY doc_id, level, above ORDER BY draw, path) = 1
),
placed AS (
  SELECT s.doc_id, s.size, s.k, s.shard, g.draw AS top_draw
  FROM won g
  JOIN won r ON r.doc_id = g.doc_id AND r.level = 2 AND r.above = g.path
  JOIN won s ON s.doc_id = g.doc_id AND s.level = 3 AND s.above = r.path
  WHERE g.level = 1
),
bytes AS (
  SELECT doc_id, list_prepend(4294967295::UBIGINT,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::UBIGINT)) AS b
  FROM documents
),
crcs AS (SELECT doc_id, xor(list_reduce(b, lambda c, x: STEP), 4294967295::UBIGINT)::BIGINT AS text_crc32 FROM bytes),
joined AS (
  SELECT p.doc_id, p.size, c.text_crc32, p.shard,
    CASE WHEN -ln((('0x' || substr(md5(k || '/g+40'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) < top_draw THEN 40 ELSE p.shard END AS grown_shard
  FROM placed p JOIN crcs c ON c.doc_id = p.doc_id
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INT AS shard, grown_shard::INT AS grown_shard,
  row_number() OVER (PARTITION BY shard
    ORDER BY ('0x' || substr(md5(doc_id::VARCHAR), 1, 3))::BIGINT % 1024, doc_id, text_crc32, size) - 1 AS slot
FROM joined
"""

# crc32 takes half a byte at a time.  Fixed values: its remainders of 0 to 15.
NIBBLES = (
    "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,"
    " 3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"
)


def _half(c: str) -> str:
    return f"xor({c} >> 4, {NIBBLES}[(({c}) & 15)::INT + 1]::UBIGINT)"


OP2 = OP2.replace("STEP", _half(_half("xor(c, x)")))

OP3 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d)
),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + range) AS n FROM repeated, range(5) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, text, line,
    lower(regexp_replace(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', ' ', 'g')) AS form,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d)
),
own AS (SELECT * FROM lines WHERE words > 0),
repeats AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM own GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT text) AS n FROM d GROUP BY source),
frequent AS (
  SELECT o.source, o.form FROM own o JOIN hosts h ON h.source IS NOT DISTINCT FROM o.source
  GROUP BY o.source, o.form, h.n HAVING count(DISTINCT o.text) > greatest(20, least(0.02 * h.n, 10000))
),
gone AS (
  SELECT o.doc_id, sum(o.words) AS n
  FROM own o JOIN frequent f ON f.source IS NOT DISTINCT FROM o.source AND f.form = o.form GROUP BY o.doc_id
),
counts AS (
  SELECT d.doc_id, len(d.words)::BIGINT AS n_words, length(array_to_string(d.words, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(d.text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(r.n, 0)::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(g.n, 0)::BIGINT AS n_frequent_words
  FROM d LEFT JOIN repeats r ON r.doc_id = d.doc_id LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN gone g ON g.doc_id = d.doc_id
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * (n_words - n_frequent_words) >= 40 * n_words AS kept
FROM counts
"""

OP8 = r"""
WITH lines AS (
  SELECT doc_id, i, line, md5(line) AS h
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
),
ends AS (
  SELECT *, coalesce(('0x' || substr(md5(lag(h) OVER own || h), 1, 8))::BIGINT % 3 = 0, false) AS last
  FROM lines WINDOW own AS (PARTITION BY doc_id ORDER BY i)
),
begun AS (SELECT *, coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY i), false)::INT AS opens FROM ends),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS no FROM begun),
chunks AS (
  SELECT doc_id, no, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) FILTER (trim(line) <> '') > 1 AS several
  FROM numbered GROUP BY doc_id, no
),
judged AS (
  SELECT *, several AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, no) > 1 AS dropped FROM chunks
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(j.text, '') END AS text, coalesce(j.n, 0)::INT AS n_removed_chunks
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(chunk, chr(10) ORDER BY no) FILTER (NOT dropped) AS text, count(*) FILTER (dropped) AS n
  FROM judged GROUP BY doc_id
) j ON j.doc_id = d.doc_id
"""

# Every row of ``rebuilt`` is one prefix of one conversation; nodes are distinct
# prefixes.  A node belongs to the subtrees of all prefixes of its smallest member.
OP12 = r"""
WITH t AS (
  SELECT conv_id, role, text, sha256(strlen(role) || ':' || role || text) AS digest,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(role, 1, 64), substr(text, 1, 64),
                            sha256(strlen(role) || ':' || role || text)) AS k
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
),
ids AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base, list_prepend(4294967295::UBIGINT,
    list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda x: ('0x' || x)::UBIGINT)) AS b
  FROM t
),
convs AS (
  SELECT conv_id, base, xor(list_reduce(b, lambda c, x: STEP), 4294967295::UBIGINT)::BIGINT % 6 AS h FROM ids
),
joined AS (
  SELECT c.conv_id, 0 AS part, t.k, t.digest, t.text FROM convs c JOIN t ON t.conv_id = c.base AND t.k <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.k, t.digest, t.text FROM convs c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h
),
rebuilt AS (
  SELECT conv_id, row_number() OVER own AS depth, string_agg(digest, ',') OVER own AS seq, length(text) AS chars
  FROM joined WINDOW own AS (PARTITION BY conv_id ORDER BY part, k)
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM convs
),
prefixes AS (
  SELECT conv_id, depth, seq, chars, lag(seq) OVER own AS above, lead(depth) OVER own IS NULL AS ends
  FROM rebuilt WINDOW own AS (PARTITION BY conv_id ORDER BY depth)
),
nodes AS (
  SELECT seq, depth, min(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY seq, depth
),
children AS (SELECT above AS seq, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above),
below AS (
  SELECT p.seq, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth
  LEFT JOIN children c ON c.seq = n.seq
  GROUP BY p.seq
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n
JOIN below b ON b.seq = n.seq
LEFT JOIN children c ON c.seq = n.seq
LEFT JOIN nodes up ON n.depth > 0 AND up.seq = n.above
"""
OP12 = OP12.replace("STEP", _half(_half("xor(c, x)")))

ORACLE: dict[str, str] = {
    "op1_quotation_links": OP1,
    "op2_hash_tree": OP2,
    "op3_line_frequency": OP3,
    "op8_line_chunks": OP8,
    "op12_conversation_trie": OP12,
}
