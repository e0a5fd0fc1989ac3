"""The queries' results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from logstow.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

QUALITY_RULES = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
l AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines,
         len(regexp_extract_all(text, '!'))::BIGINT AS n_exclamations,
         len(list_filter(w, lambda x: x IN ({_STOP})))::BIGINT AS n_stop_words
  FROM d LEFT JOIN l USING (doc_id) LEFT JOIN repeats USING (doc_id)),
b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND n_words <= 1000000
       AND word_chars::DOUBLE / n_words BETWEEN 2.5 AND 14
       AND n_symbols::DOUBLE / n_words <= 0.1
       AND n_exclamations::DOUBLE / n_words <= 0.2
       AND n_stop_words::DOUBLE / n_words >= 0.05
       AND n_dup_lines::DOUBLE / n_lines <= 0.5 AS kept,
       n_lines, n_exclamations, n_stop_words
FROM b
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         list_inner_product(q.c::DOUBLE[], d.c::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.c) = len(d.c)
  WHERE q.vec_id % 100 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

# The checksum of an id's decimal digits, a bit at a time; -1 stands for a shift.
_CRC32 = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
                      WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _row_digest(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    parts = [f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


# Trees are named by '+' and the language, '' without one; '!' is the tree above them.
MERKLE = f"""
WITH RECURSIVE
d AS (
  SELECT doc_id, coalesce('+' || lang, '') AS tree, {_row_digest("text")} AS leaf,
         {_row_digest(f"CASE WHEN {_CRC32} % 3 = 0 THEN translate(text, {_LETTERS}) ELSE text END")}
           AS claimed
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS i FROM d),
low AS (
  SELECT tree, 0 AS level, i, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, i // 8, sha256(string_agg(digest, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM low) WHERE c > 1
  GROUP BY tree, level, i // 8),
heights AS (SELECT tree, max(level) AS height FROM low GROUP BY tree),
subroots AS (
  SELECT low.tree, level, digest, row_number() OVER (ORDER BY low.tree) - 1 AS j
  FROM low JOIN heights ON low.tree = heights.tree AND level = height),
high AS (
  SELECT 0 AS level, j AS i, digest FROM subroots
  UNION ALL
  SELECT level + 1, i // 8, sha256(string_agg(digest, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER () AS c FROM high) WHERE c > 1 GROUP BY level, i // 8),
nodes AS (
  SELECT low.tree, level, i, digest,
         CASE WHEN level < height THEN low.tree ELSE '!' END AS up_tree,
         CASE WHEN level < height THEN level + 1 ELSE 1 END AS up_level,
         CASE WHEN level < height THEN i // 8 ELSE j // 8 END AS up_i,
         CASE WHEN level < height THEN i % 8 ELSE j % 8 END AS place
  FROM low JOIN heights USING (tree) JOIN (SELECT tree, j FROM subroots) USING (tree)
  UNION ALL
  SELECT '!', level, i, digest, '!', level + 1, i // 8, i % 8 FROM high WHERE level > 0),
runs AS (
  SELECT up_tree, up_level, up_i, list(digest ORDER BY place) AS run
  FROM nodes GROUP BY ALL),
top AS (SELECT digest AS root, level AS top_level FROM high ORDER BY level DESC LIMIT 1),
climb AS (
  SELECT doc_id, leaf, l.tree, l.tree AS at_tree, 0 AS at_level, i AS at_i,
         claimed AS folded, '' AS proof
  FROM leaves l
  UNION ALL
  SELECT c.doc_id, c.leaf, c.tree, n.up_tree, n.up_level, n.up_i,
         sha256(array_to_string(list_transform(run,
           lambda x, k: CASE WHEN k = place + 1 THEN folded ELSE x END), '')),
         proof || array_to_string(list_filter(run, lambda x, k: k <> place + 1), '')
  FROM climb c
  JOIN nodes n ON n.tree = at_tree AND n.level = at_level AND n.i = at_i
  JOIN runs r ON r.up_tree = n.up_tree AND r.up_level = n.up_level AND r.up_i = n.up_i
  WHERE NOT (at_tree = '!' AND at_level = (SELECT top_level FROM top))
    AND NOT ((SELECT count(*) FROM subroots) = 1
             AND at_level = (SELECT max(height) FROM heights))),
ends AS (SELECT * FROM climb QUALIFY row_number() OVER (
  PARTITION BY doc_id, leaf ORDER BY (at_tree = '!') DESC, at_level DESC) = 1)
SELECT doc_id, leaf, s.digest AS subroot, root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = root AS verified
FROM ends e JOIN subroots s USING (tree), top
"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(list_transform(
    string_split_regex(translate(coalesce(text, ''), {_LETTERS}), '[.,;:!?
-]'),
    lambda p: regexp_extract_all(p, '[^ 	]+'))) AS w
  FROM documents),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS n
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS k))
  GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, n AS a FROM f WHERE k > 1 AND n >= 30),
cuts AS (
  SELECT lang, phrase, a, w, cut, array_to_string(w[1:cut], ' ') AS head,
         array_to_string(w[cut + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
scored AS (
  SELECT u.lang, u.phrase, u.a, cut, h.n AS l, t.n AS r,
         (2000000::HUGEINT * a // (h.n + t.n))::BIGINT AS score
  FROM cuts u JOIN f h ON h.lang = u.lang AND h.phrase = head
  JOIN f t ON t.lang = u.lang AND t.phrase = tail
  QUALIFY row_number() OVER (PARTITION BY u.lang, u.phrase ORDER BY score, cut) = 1),
around AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS m FROM c))
  GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
       s.phrase, a, l, r, n, score
FROM scored s JOIN totals USING (lang) LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY rank <= 2000
"""
