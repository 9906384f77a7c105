"""The same rows in DuckDB SQL, where SQL can express an operator."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM n
WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id), g AS (PARTITION BY text_sha256)
"""

# Targets: the level is the one at which all sources below their most use up the rest.
MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, len({WORDS}) AS size, length(coalesce(text, '')) AS chars FROM documents),
k AS (
  SELECT *, (('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12))::BIGINT::DOUBLE + 0.5)
            / 281474976710656.0 AS u,
         coalesce(greatest(least((chars - size + 1)::DOUBLE / nullif(size, 0) / 5.0,
                                 5.0 / ((chars - size + 1)::DOUBLE / nullif(size, 0))), 0.01), 0.01) AS q
  FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, coalesce(sum(3 * source_size) OVER p, 0) AS full_before, coalesce(sum(w) OVER p, 0) AS w_before,
         sum(source_size) OVER () AS total, sum(w) OVER () AS w_all, row_number() OVER r AS place
  FROM s
  WINDOW r AS (ORDER BY (3 * source_size)::DOUBLE / w, encode(source) NULLS LAST),
         p AS (ORDER BY (3 * source_size)::DOUBLE / w, encode(source) NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - full_before)::DOUBLE / (w_all - w_before)::DOUBLE AS level FROM o),
open_level AS (SELECT min_by(level, place) AS level FROM l WHERE level * w < 3 * source_size),
t AS (
  SELECT source, source_size,
         CASE WHEN source_size > 0 THEN least(3.0 * source_size, w * coalesce((SELECT level FROM open_level), 0.0))
              ELSE 0.0 END::DOUBLE AS target
  FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
f AS (
  SELECT k.*, source_size, target, epochs, round(target)::BIGINT - epochs * source_size AS rest,
         sum(size) OVER (PARTITION BY k.source ORDER BY -ln(u) / q, doc_id) - size AS before
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken
FROM f
"""

# Sets of shingles as sorted word sequences; pairs by shared shingles; components by reachability.
NEAR_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(shingle) AS shingle
  FROM (SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
                                   WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                                   ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))
                              END) AS shingle FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * common >= 80 * (x.n + y.n - common)),
r AS (
  SELECT doc_id AS node, doc_id AS reached FROM n
  UNION
  SELECT r.node, CASE WHEN e.a = r.reached THEN e.b ELSE e.a END
  FROM r JOIN e ON e.a = r.reached OR e.b = r.reached),
c AS (SELECT node, min(reached) AS component FROM r GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component, w.doc_id) AS component_id,
       w.doc_id = coalesce(c.component, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = w.doc_id
"""

# Five hexadecimal digits are four of base 32.
WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, payload_bytes,
         array_to_string(list_transform(range(0, 8), lambda k: array_to_string(list_transform([15, 10, 5, 0], lambda s:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((('0x' || substr(hex, 5 * k + 1, 5))::INT >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
         min(page_id) OVER (PARTITION BY hex) AS least
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> least THEN least END AS refers_to
FROM d
"""

# Window k of a document covers words k to k + 49; it counts when the sequence starts in a smaller id.
SUBSTRING_DEDUP = rf"""
WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
h AS (
  SELECT doc_id, k, hash(array_to_string(words[k:k + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS k FROM w WHERE len(words) >= 50)),
m AS (SELECT h, min(doc_id) AS least FROM h GROUP BY h),
r AS (SELECT doc_id, list(k) AS starts FROM h JOIN m USING (h) WHERE least < doc_id GROUP BY doc_id),
c AS (
  SELECT doc_id, list(DISTINCT k + j) AS gone
  FROM (SELECT doc_id, unnest(starts) AS k FROM r), range(0, 50) AS o(j) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, words, coalesce(len(gone), 0) AS n_removed,
         CASE WHEN gone IS NULL THEN words
              ELSE list_select(words, list_sort(list_filter(range(1, len(words) + 1), lambda i: NOT map_contains(gone_map, i)))) END AS kept
  FROM w LEFT JOIN (SELECT *, map_from_entries(list_transform(gone, lambda g: (g, true))) AS gone_map FROM c) c USING (doc_id))
SELECT doc_id, len(words) AS n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM f
"""

# Pairs of one label by cosine; vectors that can have none are left out.
EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (
  SELECT * FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (
  SELECT vec_id AS node, vec_id AS reached FROM u
  UNION
  SELECT r.node, l.b FROM r JOIN l ON l.a = r.reached),
c AS (SELECT node, min(reached) AS component FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.component, v.vec_id) AS component_id,
       v.vec_id = coalesce(c.component, v.vec_id) AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN c ON c.node = v.vec_id
"""

# Words follow each other inside pieces; a phrase as its words joined by a space, which no word holds.
COLLOCATIONS = r"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
w AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM p),
e AS (SELECT lang, words[i] AS w1, words[i + 1] AS w2, words[i + 2] AS w3 FROM w),
f1 AS (SELECT lang, w1 AS phrase, count(*) AS f FROM e GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, w1 || ' ' || w2 AS phrase, count(*) AS f FROM e WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM e WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
c AS (
  SELECT lang, phrase, f AS a, 1 AS cut, w1 AS lft, w2 AS rgt FROM f2
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, f, 1, w1, w2 || ' ' || w3 FROM f3
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, f, 2, w1 || ' ' || w2, w3 FROM f3),
f AS (SELECT * FROM f1 UNION ALL SELECT lang, phrase, f FROM f2),
s AS (
  SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM c JOIN f AS x ON x.lang = c.lang AND x.phrase = lft JOIN f AS y ON y.lang = c.lang AND y.phrase = rgt),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS pick FROM s),
g AS (
  SELECT lang, phrase, max(f) AS longer
  FROM (SELECT lang, w1 || ' ' || w2 AS phrase, f FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, f FROM f3) GROUP BY ALL),
q AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
  FROM b LEFT JOIN g ON g.lang = b.lang AND g.phrase = b.phrase
  WHERE pick = 1 AND (longer IS NULL OR 100 * longer < 50 * a))
SELECT lang, rank, phrase, a, l, r, n, score
FROM q JOIN (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang) USING (lang)
WHERE rank <= 2000
"""

# The digest of bytes by a table that follows from its polynomial.
CRC_TABLE = """(SELECT list_transform(range(256), lambda c: list_reduce(range(8), lambda a, i:
           CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, c)) AS crcs)"""


def crc32(octets: str) -> str:
    """Digest of a list of hexadecimal bytes."""
    return f"""xor(list_reduce(list_transform({octets}, lambda x: ('0x' || x)::BIGINT),
           lambda a, x: xor(a >> 8, crcs[(xor(a & 255, x) + 1)::INT]), 4294967295), 4294967295)"""


# The generator in 128-bit numbers, a row for each step of a key.
SHARDING = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), chr(0))), 1, 16))::UBIGINT AS key
  FROM documents),
j AS (
  SELECT row, key AS state, -1::BIGINT AS b, 0::BIGINT AS j FROM d
  UNION ALL
  SELECT row, next, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((next >> 33) + 1)::DOUBLE))::BIGINT
  FROM (SELECT row, j, ((state::UHUGEINT * 2862933555777941757 + 1) % 18446744073709551616)::UBIGINT AS next FROM j WHERE j < 8)),
s AS (SELECT row, max(b)::INT AS shard, max(j) AS reach FROM j GROUP BY row),
t AS {CRC_TABLE},
c AS (
  SELECT row, {crc32('bytes')} AS crc
  FROM (SELECT row, regexp_extract_all(hex(encode(text)), '..') AS bytes FROM d), t)
SELECT doc_id, octet_length(encode(text)) + 1 AS size, crc AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, octet_length(encode(text)), crc) - 1 AS slot,
       CASE WHEN reach = 8 THEN 8 ELSE shard END AS grown_shard
FROM d JOIN s USING (row) JOIN c USING (row)
"""

# Nodes are prefixes in letters; each adds to all prefixes of its smallest member.
CONVERSATION_TRIE = rf"""
WITH t AS {CRC_TABLE},
o AS (
  SELECT conv_id AS c, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, turns, c - c % 5 AS base, {crc32("regexp_extract_all(hex(encode(CAST(c AS VARCHAR))), '..')")} % 9 AS h FROM o, t),
r AS (
  SELECT h.c, CASE WHEN h.c = base THEN h.turns
                   ELSE list_concat(coalesce(b.turns[1:h], []), h.turns[h + 1:]) END AS turns
  FROM h LEFT JOIN o AS b ON b.c = base AND h.c <> base),
p AS (
  SELECT c, d, md5(CAST(turns[1:d] AS VARCHAR)) AS key, d = len(turns) AS ends,
         CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(turns[d].text)) END AS bytes
  FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM r)),
n AS (
  SELECT key, d AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS own,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY key, d),
m AS (SELECT n.key, p.key AS parent FROM n JOIN p ON p.c = n.conv_id AND p.d = n.depth - 1),
k AS (SELECT parent, count(*) AS n_children FROM m GROUP BY parent),
u AS (
  SELECT p.key, sum(n.own)::BIGINT AS saved_tokens, count(*) FILTER (k.parent IS NULL) AS n_leaves
  FROM n LEFT JOIN k ON k.parent = n.key JOIN p ON p.c = n.conv_id AND p.d <= n.depth GROUP BY p.key)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       u.n_leaves, u.saved_tokens, n.ends_sha256
FROM n LEFT JOIN m ON m.key = n.key LEFT JOIN n AS q ON q.key = m.parent
  LEFT JOIN k ON k.parent = n.key JOIN u ON u.key = n.key
"""

SQL = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op2_mix_sources": MIXING,
    "op3_near_dedup": NEAR_DEDUP,
    "op4_warc": WARC,
    "op5_substring_dedup": SUBSTRING_DEDUP,
    "op7_embedding_dedup": EMBEDDING_DEDUP,
    "op11_collocations": COLLOCATIONS,
    "op12_sharding": SHARDING,
    "op13_conversation_trie": CONVERSATION_TRIE,
}
