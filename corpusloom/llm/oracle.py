"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

_LINES = r"list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))"

SQL["op1_quality_rules"] = rf"""
WITH split AS (
  SELECT doc_id, text, row_number() OVER () AS id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT id, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS w
  FROM (SELECT id, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), found AS (
  SELECT id, i, count(*) OVER (PARTITION BY id, w) AS n FROM windows
), covered AS (
  SELECT id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT id, unnest([i, i + 1, i + 2]) AS p FROM found WHERE n > 1) GROUP BY id
), counts AS (
  SELECT s.doc_id, s.text, len(words) AS n_words,
         length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols,
         coalesce(len({_LINES}) - len(list_distinct({_LINES})), 0) AS n_dup_lines,
         coalesce(c.n_repeat_words, 0) AS n_repeat_words
  FROM split s LEFT JOIN covered c USING (id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    4 * n_symbols > n_words
    OR word_chars < 2 * n_words OR word_chars > 14 * n_words
    OR 10 * n_dup_lines > 3 * len(string_split(text, chr(10)))
    OR 2 * length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) > word_chars
    OR 2 * length(regexp_replace(text, '[\p{{L}}\p{{M}}\x20\x09-\x0D]+', '', 'g')) > word_chars
    OR 5 * len(regexp_extract_all(text, '[!?]{{2,}}')) > n_words AS rejected
  FROM counts
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rejected, FALSE) AS kept
FROM judged
"""

SQL["op9_warc"] = """
WITH RECURSIVE digests AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
  SELECT page_id, html, hex, array_to_string(list_transform(range(1, 41), lambda i:
    right('000' || bin(('0x' || hex[i])::INT), 4)), '') AS b FROM digests
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (list_sum(list_transform(range(0, 5), lambda j:
        (substr(b, (5 * i + j + 1)::BIGINT, 1)::INT * pow(2, 4 - j))::INT)) + 1)::BIGINT, 1)), '')
    AS payload_digest,
  CASE WHEN min(page_id) OVER same = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN min(page_id) OVER same = page_id THEN NULL ELSE min(page_id) OVER same END AS refers_to
FROM bits WINDOW same AS (PARTITION BY html)
"""


# kind, rank, pattern, condition on hit h and the lower-cased text before it b
_PII = [
    ("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "TRUE"),
    (
        "ip", 1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "list_bool_and(list_transform(string_split(h, '.'), lambda p: length(ltrim(p, '0')) <= 3 "
        "AND coalesce(try_cast(right(p, 3) AS INT), 0) <= 255))",
    ),
    (
        "card", 2, r"[0-9]([\x20-]?[0-9])+",
        "length(d) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: "
        "CASE WHEN i % 2 = 1 THEN substr(reverse(d), i, 1)::INT "
        "WHEN 2 * substr(reverse(d), i, 1)::INT > 9 THEN 2 * substr(reverse(d), i, 1)::INT - 9 "
        "ELSE 2 * substr(reverse(d), i, 1)::INT END)) % 10 = 0",
    ),
    ("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 10 AND 15"),
    (
        "iban", 4, r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
        "length(replace(h, ' ', '')) BETWEEN 15 AND 34 AND "
        "list_reduce(list_prepend(0, list_transform(string_split(substr(replace(h, ' ', ''), 5) || "
        "left(replace(h, ' ', ''), 4), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c::INT "
        "ELSE ascii(c) - 55 END)), lambda a, x: CASE WHEN x > 9 THEN (a * 100 + x) % 97 "
        "ELSE (a * 10 + x) % 97 END) = 1",
    ),
    (
        "ssn", 5, r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        "NOT regexp_matches(b, '[0-9-]$') AND "
        "regexp_matches(b, 'ssn|social security|sozialversicherung')",
    ),
    (
        "secret", 6,
        r"(?:password|passwd|secret|token|api_key|apikey)\x20?[=:]\x20?[\"'']?"
        r"[A-Za-z0-9_+/.=-]{8,}|AKIA[0-9A-Z]{16}",
        "regexp_matches(h, '[0-9]')",
    ),
]

_PII_PARTS = " UNION ALL ".join(
    f"""
  SELECT id, '{kind}' AS kind, {rank} AS rank, h, start, start + length(h) AS stop FROM (
    SELECT id, h, b, regexp_replace(h, '[^0-9]', '', 'g') AS d,
           sum(length(p) + length(h)) OVER (PARTITION BY id ORDER BY i) - length(h) AS start
    FROM (SELECT id, i, hits[i] AS h, pieces[i] AS p, lower(right(pieces[i], 40)) AS b FROM (
      SELECT id, hits, pieces, unnest(range(1, len(hits) + 1)) AS i FROM (
        SELECT id, regexp_extract_all(text, '{pattern}') AS hits,
               regexp_split_to_array(text, '{pattern}') AS pieces FROM numbered)))
  ) WHERE {condition}"""
    for kind, rank, pattern, condition in _PII
)

SQL["op4_pii"] = f"""
WITH numbered AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS id FROM documents
), found AS ({_PII_PARTS}), listed AS (
  SELECT id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
    count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)
      FILTER (rank < 4) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM found GROUP BY id
)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip,
  coalesce(n_card, 0)::BIGINT AS n_card, coalesce(n_phone, 0)::BIGINT AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM numbered LEFT JOIN listed USING (id)
"""

def _components(words, least, more=""):
    """Components of documents whose sets of shingles are ``least`` percent similar."""
    return rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, row_number() OVER () AS id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), tokens AS (
  SELECT DISTINCT id, array_to_string(w[i:i + {words - 1}], chr(10)) AS token
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - {words - 2}, 2))) AS i FROM split WHERE len(w) > 0)
), sizes AS (
  SELECT id, count(*) AS n FROM tokens GROUP BY id
), sets AS (
  SELECT id, md5(string_agg(token, chr(0) ORDER BY token)) AS kind FROM tokens GROUP BY id
), chosen AS (
  SELECT kind, min(id) AS id FROM sets GROUP BY kind
), few AS (
  SELECT t.id, t.token FROM tokens t JOIN chosen USING (id)
), shared AS (
  SELECT a.id AS a, b.id AS b, count(*) AS common
  FROM few a JOIN few b ON a.token = b.token AND a.id < b.id GROUP BY a.id, b.id
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b
  WHERE 100 * common >= {least} * (x.n + y.n - common)
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
  UNION SELECT s.id, c.id FROM sets s JOIN chosen c USING (kind)
  UNION SELECT c.id, s.id FROM sets s JOIN chosen c USING (kind)
), reached(start, id) AS (
  SELECT id, id FROM split
  UNION
  SELECT r.start, edges.b FROM reached r JOIN edges ON edges.a = r.id
)
SELECT s.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id{more}
FROM split s LEFT JOIN sizes USING (id) JOIN (
  SELECT r.start AS id, min(t.doc_id) AS component_id
  FROM reached r JOIN split t ON t.id = r.id GROUP BY r.start
) c USING (id)
"""


SQL["op6_ngram_jaccard"] = _components(3, 90)
SQL["op12_minhash_duplicates"] = _components(5, 85, ", s.doc_id = c.component_id AS kept")


def _field(column):
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


def _leaf(text):
    return "sha256(" + " || ".join(
        _field(c) for c in ("doc_id", "source", "lang", "n_chars", text)
    ) + ")"


def _tree(nodes, width, prefix):
    """Levels of trees over ``nodes (grp, pos, node)``; a level that ends keeps its node."""
    parts = [f"{prefix}0 AS (SELECT grp, pos, node, count(*) OVER (PARTITION BY grp) AS n FROM {nodes})"]
    for i in range(1, width + 1):
        parts.append(f"""{prefix}{i} AS (
  SELECT grp, pos // 8 AS pos,
    CASE WHEN max(n) > 1 THEN sha256(string_agg(node, '' ORDER BY pos)) ELSE max(node) END AS node,
    count(*) OVER (PARTITION BY grp) AS n
  FROM {prefix}{i - 1} GROUP BY grp, pos // 8)""")
    return ", ".join(parts)


def _climb(rows, width, prefix):
    """``rows (grp, pos, proof, folded)`` taken up a level at a time."""
    parts, last = [], rows
    for i in range(width):
        name = f"{rows}_{prefix}{i}"
        parts.append(f"""{prefix}s{i} AS (
  SELECT grp, pos, max(n) AS n,
    coalesce(string_agg(other, '' ORDER BY place) FILTER (place < pos), '') AS before,
    coalesce(string_agg(other, '' ORDER BY place) FILTER (place > pos), '') AS after
  FROM (SELECT a.grp, a.pos, a.n, b.pos AS place, b.node AS other FROM {prefix}{i} a
        JOIN {prefix}{i} b ON a.grp = b.grp AND a.pos // 8 = b.pos // 8) GROUP BY grp, pos
), {name} AS (
  SELECT r.* REPLACE (r.pos // 8 AS pos, proof || before || after AS proof,
    CASE WHEN n > 1 THEN sha256(before || folded || after) ELSE folded END AS folded)
  FROM {last} r JOIN {prefix}s{i} s ON r.grp = s.grp AND r.pos = s.pos)""")
        last = name
    return ", ".join(parts), last


_LEVELS, _GROUP_LEVELS = 10, 4      # enough for 8 ** 10 rows of 8 ** 4 languages
_UP, _TOP = _climb("rows", _LEVELS, "t")
_OVER, _LAST = _climb("named", _GROUP_LEVELS, "g")

SQL["op13_merkle_manifest"] = rf"""
WITH leaves AS (
  SELECT doc_id, coalesce('v' || lang, 'n') AS lang, {_leaf("text")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND crc % 3 = 0 THEN
      {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
    END AS fresh
  FROM (SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, c:
      list_reduce(list_prepend(xor(a, c), range(8)), lambda x, i:
        CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS inverse,
    xor(inverse, 4294967295::BIGINT) AS crc FROM documents)
), placed AS (
  SELECT lang AS grp, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos,
    doc_id, leaf, leaf AS node, fresh FROM leaves
), {_tree("placed", _LEVELS, "t")}, rows AS (
  SELECT doc_id, leaf, grp, pos, '' AS proof, coalesce(fresh, leaf) AS folded FROM placed
), {_UP}, subroots AS (
  SELECT '' AS grp, grp AS lang, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos, node FROM t{_LEVELS}
), {_tree("subroots", _GROUP_LEVELS, "g")}, named AS (
  SELECT r.doc_id, r.leaf, r.proof, r.folded, s.node AS subroot, s.grp, s.pos
  FROM {_TOP} r JOIN subroots s ON r.grp = s.lang
), {_OVER}
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = node AS verified
FROM {_LAST} JOIN g{_GROUP_LEVELS} USING (grp)
"""
