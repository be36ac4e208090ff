"""DuckDB SQL for the operators that SQL can express over whole tables.

The others have none: token ids need the tokenizer, a mix and a score need hashes
or training that DuckDB lacks, the Jaccard join and decontamination would be self-joins
over all texts, and page markup, secret spans and chat escapes need parsers; tests
hold those against plain versions.
"""

from __future__ import annotations

from quarry.llm.quality import LINES_FROM, MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_FROM, STOP_WORDS, WINDOW

#: CRC-32 of a decimal number as SQL: bytes of its text, eight steps for each.
CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''),
    lambda ch: ascii(ch)::BIGINT)), lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
    lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


def crc32(number: str) -> str:
    return CRC32.format(text=f"CAST({number} AS VARCHAR)")


def _quality() -> str:
    stops = ", ".join("'%s'" % w for w in sorted(set(STOP_WORDS)))
    bounds = []
    for name, least, most in RULES:
        bounds += [f"coalesce({name} >= {least}, true)"] if least is not None else []
        bounds += [f"coalesce({name} <= {most}, true)"] if most is not None else []
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
place AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
win AS (
  SELECT doc_id, i, count(*) OVER five = {WINDOW} AS whole, list(word) OVER five AS five
  FROM place WINDOW five AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
again AS (SELECT doc_id, i FROM win WHERE whole QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
covered AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + unnest(range({WINDOW})) AS i FROM again) GROUP BY doc_id),
counts AS (
  SELECT words.doc_id, t, l, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM words JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
ratios AS (
  SELECT *,
    CASE WHEN n_words >= 1 THEN word_chars / n_words END AS mean_word_chars,
    CASE WHEN n_words >= 1 THEN n_symbols / n_words END AS symbol_ratio,
    CASE WHEN n_words >= 1 THEN (length(t) - length(regexp_replace(t, '[!?{{}}~^\\\\=]', '', 'g'))) / n_words END AS mark_ratio,
    CASE WHEN n_words >= {STOP_FROM} THEN len(list_filter(regexp_split_to_array(lower(t), '[^\\p{{L}}]+'),
      lambda x: list_contains([{stops}], x))) / n_words END AS stop_ratio,
    CASE WHEN len(l) >= {LINES_FROM} THEN n_dup_lines / len(l) END AS dup_line_ratio,
    CASE WHEN len(l) >= {LINES_FROM} THEN len(list_filter(l, lambda s: regexp_matches(s, '^\\s*[-*•‣▪]'))) / len(l) END AS bullet_line_ratio,
    CASE WHEN len(l) >= {LINES_FROM} THEN len(list_filter(l, lambda s: regexp_matches(s, '(\\.\\.\\.|…)\\s*$'))) / len(l) END AS ellipsis_line_ratio,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(bounds)} AS kept
FROM ratios"""


WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS least FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN least = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN least <> page_id THEN least END AS refers_to
FROM r"""

# A node is its path: the hashes of its turns, one after another.
TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv_id, {crc32('conv_id')} % 4 AS h FROM turns),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t USING (conv_id) WHERE t.pos >= c.h),
steps AS (
  SELECT conv_id, row_number() OVER w AS depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
         string_agg(sha256(concat(length(role), ':', role, text)), '') OVER w AS path
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
passed AS (
  SELECT conv_id, 0 AS depth, 0 AS words, '' AS path FROM convs
  UNION ALL SELECT conv_id, depth, words, path FROM steps),
ends AS (
  SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
  FROM passed QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)),
last AS (SELECT conv_id, path FROM passed QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)),
end_lists AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM last GROUP BY path),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS own FROM passed GROUP BY path, depth),
kin AS (SELECT n.path, p.path AS up FROM nodes n JOIN nodes p ON p.depth = n.depth - 1 AND p.path = left(n.path, CAST(64 * (n.depth - 1) AS BIGINT))),
children AS (SELECT up AS path, count(*) AS n FROM kin GROUP BY up),
below AS (
  SELECT a.path, CAST(sum(b.own) AS BIGINT) AS saved, CAST(sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS leaves
  FROM nodes b LEFT JOIN children c USING (path), unnest(range(b.depth + 1)) AS u(d)
  JOIN nodes a ON a.path = left(b.path, CAST(64 * u.d AS BIGINT)) GROUP BY a.path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, b.leaves AS n_leaves,
       b.saved AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM nodes n JOIN below b USING (path) LEFT JOIN kin k USING (path) LEFT JOIN nodes p ON p.path = k.up
LEFT JOIN children c ON c.path = n.path LEFT JOIN end_lists e ON e.path = n.path"""
TRIE = TRIE.replace('''ends AS (
  SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
  FROM passed QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)),
''', "")



def _encoded(fields: dict[str, str]) -> str:
    return "concat(" + ", ".join(
        f"CASE WHEN {x} IS NULL THEN '-' ELSE concat(strlen(CAST({x} AS VARCHAR)), ':', CAST({x} AS VARCHAR)) END"
        for x in fields.values()) + ")"


def _levels(name: str, leaves: str) -> str:
    """A table of the nodes (tree, n, lvl, pos, h) of all levels of the trees over ``leaves``."""
    return f"""{name} AS (
  SELECT tree, n, 0 AS lvl, pos, h FROM {leaves}
  UNION ALL
  SELECT tree, (n + 2) // 3, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1
  GROUP BY tree, n, lvl, pos // 3)"""


def _siblings(nodes: str, leaf: str, tree: str, pos: str) -> str:
    """Per leaf and level the nodes left and right of its own, in its run."""
    return f"""SELECT {leaf} AS leaf_no, own.lvl, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < own.pos), '') AS lft,
         coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > own.pos), '') AS rgt
  FROM leaves l JOIN {nodes} own ON own.tree = {tree} AND own.n > 1 AND own.pos = {pos} // CAST(pow(3, own.lvl) AS BIGINT)
  LEFT JOIN {nodes} s ON s.tree = own.tree AND s.lvl = own.lvl AND s.pos // 3 = own.pos // 3 AND s.pos <> own.pos
  GROUP BY leaf_no, own.lvl"""


_FIELDS = {c: c for c in ("doc_id", "source", "lang", "n_chars", "text")}
MERKLE = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, sha256({_encoded(_FIELDS)}) AS h,
         CASE WHEN {crc32('doc_id')} % 2 = 0 AND contains(text, chr(10))
              THEN sha256({_encoded({**_FIELDS, 'text': "replace(text, chr(10), '')"})}) END AS later
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER () AS no, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM hashed),
{_levels("nodes", "leaves")},
roots AS (SELECT 0 AS tree, tree AS pos, h, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_levels("tops", "roots")},
way AS (
  SELECT leaf_no, lvl, lft, rgt FROM ({_siblings("nodes", "l.no", "l.tree", "l.pos")})
  UNION ALL
  SELECT leaf_no, 1000 + lvl, lft, rgt FROM ({_siblings("tops", "l.no", "0", "l.tree")})),
numbered AS (SELECT *, row_number() OVER (PARTITION BY leaf_no ORDER BY lvl) - 1 AS k FROM way),
proofs AS (SELECT leaf_no, sha256(string_agg(lft || rgt, '' ORDER BY k)) AS proof, count(*) AS steps FROM numbered GROUP BY leaf_no),
fold AS (
  SELECT no, 0 AS k, coalesce(later, h) AS node FROM leaves
  UNION ALL
  SELECT f.no, f.k + 1, sha256(w.lft || f.node || w.rgt) FROM fold f JOIN numbered w ON w.leaf_no = f.no AND w.k = f.k)
SELECT l.doc_id, l.h AS leaf, r.h AS subroot, t.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256, f.node AS folded_root,
       f.node = t.h AS verified
FROM leaves l JOIN roots r ON r.pos = l.tree JOIN (SELECT h FROM tops WHERE n = 1) t ON true
LEFT JOIN proofs p ON p.leaf_no = l.no JOIN fold f ON f.no = l.no AND f.k = coalesce(p.steps, 0)"""

ORACLE = {"op2_quality_rules": _quality(), "op5_warc": WARC, "op11_prefix_trie": TRIE,
          "op12_merkle_manifest": MERKLE}
