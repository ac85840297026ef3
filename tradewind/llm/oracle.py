"""SQL for the queries whose results SQL can express."""

from __future__ import annotations

from collections.abc import Iterable

from tradewind.llm.url_vocabulary import CONTRACT_RULES, DEFAULT_VOCABULARY

# Texts and roles with every lead character of a marker followed by the escape.
_ESCAPED = r"replace(replace({0}, '<', '<\'), '[', '[\')"

CHATS = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), placed AS (
  SELECT *, row_number() OVER w AS place_no,
    CASE WHEN role IN ('system', 'user', 'assistant') THEN lag(role) OVER w END AS before
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), lengths AS (
  SELECT *,
    CASE role WHEN 'system' THEN length('[SYS][/SYS]') WHEN 'user' THEN length('[INST][/INST]')
      WHEN 'assistant' THEN length('<a></s>')
      ELSE length('[ROLE][SAYS][END]') + length({_ESCAPED.format('role')}) END
    + length({_ESCAPED.format('text')}) + CASE WHEN place_no = 1 THEN length('<s>') ELSE 0 END AS written,
    coalesce(CASE role WHEN 'system' THEN place_no = 1 WHEN 'user' THEN place_no = 1 OR before IN ('system', 'assistant')
      WHEN 'assistant' THEN before = 'user' ELSE false END, false) AS ok
  FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place_no)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place_no) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(written)::BIGINT AS formatted_chars,
  bool_and(ok) AS allowed
FROM lengths GROUP BY conv_id
"""


def _found(term: str) -> str:
    return f"regexp_matches(place, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::INT"


def _sum(terms: Iterable[str]) -> str:
    return "(" + " + ".join(map(_found, terms)) + ")::INT"


# The forms of a soft term are one hit.
_SOFT = [f"({'|'.join(forms)})" for forms in DEFAULT_VOCABULARY.terms_by_name().values()]

_FITS = " UNION ALL ".join(
    f"SELECT '{rule.partition('/')[0]}' AS rule_host, '/{rule.partition('/')[2]}' AS rule_path, "
    f"'{rule}' AS rule, '{verdict}' AS says"
    for rule, verdict in CONTRACT_RULES.items()
)

URLS = f"""
WITH rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
), judged AS (
  SELECT page_id, host, path,
    translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS place,
    (SELECT arg_max(r, length(r.rule)) FROM ({_FITS}) r
     WHERE (host = r.rule_host OR ends_with(host, '.' || r.rule_host)) AND starts_with(path, r.rule_path)) AS best
  FROM parts
), counted AS (
  SELECT *, {_sum(DEFAULT_VOCABULARY.strict)} AS strict_hits, {_sum(_SOFT)} AS soft_hits FROM judged
)
SELECT page_id, host, path, best.rule AS rule,
  coalesce(best.says, CASE WHEN strict_hits > 0 OR soft_hits >= {DEFAULT_VOCABULARY.soft_limit} THEN 'block' ELSE 'allow' END) AS verdict,
  strict_hits, soft_hits
FROM counted
"""

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# One whole character of UTF-8, in hexadecimal; a cut may leave parts of others.
_TAIL = "[89AB][0-9A-F]"
_CHARACTER = "|".join(
    [
        "[0-7][0-9A-F]", f"(?:C[2-9A-F]|D[0-9A-F]){_TAIL}", f"E0[AB][0-9A-F]{_TAIL}",
        f"(?:E[1-9A-CEF]){_TAIL}{_TAIL}", f"ED[89][0-9A-F]{_TAIL}", f"F0[9AB][0-9A-F]{_TAIL}{_TAIL}",
        f"F[1-3]{_TAIL}{_TAIL}{_TAIL}", f"F48[0-9A-F]{_TAIL}{_TAIL}",
    ]
)

# Every 400-byte window of every text, and the bytes that the repeated ones cover.
REPEATS = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, encode(coalesce(text, '')) AS said FROM documents
), windows AS (
  SELECT row_no, p, md5(said[p:p + 399]) AS h
  FROM (SELECT row_no, said, unnest(range(1, octet_length(said) - 398)) AS p FROM texts)
), again AS (
  SELECT row_no, p FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)
), runs AS (
  SELECT row_no, p, sum(opens) OVER (PARTITION BY row_no ORDER BY p) AS run
  FROM (SELECT row_no, p, CASE WHEN p <= 400 + lag(p) OVER (PARTITION BY row_no ORDER BY p) THEN 0 ELSE 1 END AS opens
        FROM again)
), spans AS (
  SELECT row_no, min(p) AS first, max(p) + 399 AS last FROM runs GROUP BY row_no, run
), pieces AS (
  SELECT s.row_no, s.first, s.last, coalesce(lag(s.last) OVER w, 0) + 1 AS kept_from, s.first - 1 AS kept_to
  FROM spans s WINDOW w AS (PARTITION BY s.row_no ORDER BY s.first)
), kept AS (
  SELECT row_no, kept_from, kept_to FROM pieces
  UNION ALL
  SELECT row_no, coalesce((SELECT max(last) FROM spans s WHERE s.row_no = t.row_no), 0) + 1, octet_length(said)
  FROM texts t
), remains AS (
  SELECT k.row_no,
    unhex(string_agg(CASE WHEN kept_to >= kept_from THEN hex(said[kept_from:kept_to]) ELSE '' END, '' ORDER BY kept_from)) AS left_over
  FROM kept k JOIN texts t ON t.row_no = k.row_no GROUP BY k.row_no
)
SELECT doc_id, octet_length(said) AS n_bytes, octet_length(said) - octet_length(left_over) AS n_removed,
  (SELECT count(*) FROM spans s WHERE s.row_no = t.row_no) AS n_spans, sha256(left_over) AS kept_sha256,
  decode(unhex(regexp_replace(hex(left_over), '({_CHARACTER})|..', '\1', 'g'))) AS text
FROM texts t JOIN remains r ON r.row_no = t.row_no
"""

# Overlaps counted by shared shingles, components by following links.
NEAR_COPIES = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingles FROM texts
), members AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other
)
SELECT s.doc_id, len(shingles) AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, shingles
"""

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES = f"""
WITH lines AS (
  SELECT doc_id, unnest(items) AS line, unnest(range(len(items))) AS place
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS items FROM documents)
), keyed AS (
  SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS line_key FROM lines
), repeated AS (
  SELECT line_key, max(doc_id) AS newest FROM keyed WHERE length(line_key) >= 20
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, coalesce(k.doc_id < r.newest, false) AS dropped
  FROM keyed k LEFT JOIN repeated r ON r.line_key = k.line_key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

# The polynomial of crc32, bits reversed.
_CRC = "3988292384"

# Pairs of equal words q apart; stretches of them are runs, named by their least q.
PERIODS = rf"""
WITH hashed AS (
  SELECT doc_id, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, c: list_reduce(list_concat([xor(crc, c)], range(8)), lambda x, i: xor(x >> 1, (x & 1) * {_CRC}))), 4294967295) AS h,
    regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w
  FROM documents
), placed AS (
  SELECT doc_id, h, w, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM hashed
), sized AS (
  SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed
), said AS (
  SELECT doc_id, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM sized)
), equal AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM said x JOIN said y ON y.doc_id = x.doc_id AND y.word = x.word AND y.i > x.i
), stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal)
  GROUP BY doc_id, q, island
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= 6 AND length >= 4 * q
  GROUP BY doc_id, start, length
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat_ws(',', start, length, period) || chr(10), '' ORDER BY start, period) AS list
  FROM runs GROUP BY doc_id
), best AS (
  SELECT DISTINCT ON (r.doc_id) r.* FROM runs r
  WHERE NOT EXISTS (SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id AND o.length * r.period > r.length * o.period)
  ORDER BY r.doc_id, r.start, r.period
), left_over AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM said s
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = s.doc_id AND s.i >= r.start + r.period AND s.i < r.start + r.length)
  GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
  sha256(coalesce(list, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN best b ON b.doc_id = d.doc_id
LEFT JOIN left_over k ON k.doc_id = d.doc_id
"""

NEGATIVES = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * r.v[i]))::BIGINT AS score
  FROM vectors a JOIN vectors r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLES = {
    "op1_chat_formatting": CHATS,
    "op3_suffix_dedup": REPEATS,
    "op5_url_filters": URLS,
    "op8_ngram_jaccard_join": NEAR_COPIES,
    "op11_line_dedup": LINES,
    "op12_periodic_runs": PERIODS,
    "op13_hard_negatives": NEGATIVES,
}
