"""DuckDB SQL of the operators that SQL can express, written independently of them."""

from __future__ import annotations

from . import importance, line_dedup, quality_rules, source_audit, url_filter

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
TRIMMED = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
KEY = f"translate(trim(line, {TRIMMED}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACE}+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)"""


def line_dedup_text(documents: str) -> str:
    """SELECT of doc_id, n_lines, n_dropped and the text left, from ``documents``."""
    return f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM {documents}),
keyed AS (SELECT *, {KEY} AS key FROM lines),
frequent AS (
  SELECT key FROM keyed WHERE length(key) >= {line_dedup.MIN_KEY_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCUMENTS}),
marked AS (SELECT k.*, f.key IS NOT NULL AS drop FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drop) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT drop), '') AS kept_text
FROM marked GROUP BY doc_id"""


LINE_DEDUP = f"SELECT doc_id, n_lines, n_dropped, sha256(kept_text) AS kept_sha256 FROM ({line_dedup_text('documents')})"

QUALITY_RULES = f"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT doc_id, unnest(regexp_extract_all(t, '{WORD}+')) AS word,
         generate_subscripts(regexp_extract_all(t, '{WORD}+'), 1) AS pos FROM texts),
windows AS (
  SELECT doc_id, pos, CASE WHEN lead(word, 4) OVER p IS NOT NULL THEN concat_ws(' ', word, lead(word, 1) OVER p,
         lead(word, 2) OVER p, lead(word, 3) OVER p, lead(word, 4) OVER p) END AS shingle
  FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY pos)),
starts AS (
  SELECT doc_id, pos, shingle IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, shingle) >= 2 AS again FROM windows),
covered AS (
  SELECT doc_id, max(CAST(again AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos ROWS 4 PRECEDING) AS hit FROM starts),
repeats AS (SELECT doc_id, CAST(sum(hit) AS BIGINT) AS n_repeat_words FROM covered GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars FROM words GROUP BY doc_id),
lines AS (
  SELECT * FROM (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '{WORD}')),
keyed AS (SELECT doc_id, source, t, line, {KEY} AS key FROM lines),
hosts AS (SELECT source, count(DISTINCT t) AS host_documents FROM texts GROUP BY source),
template AS (
  SELECT k.source, k.key FROM keyed k JOIN hosts h ON k.source IS NOT DISTINCT FROM h.source
  GROUP BY k.source, k.key, host_documents
  HAVING count(DISTINCT k.t) >= {quality_rules.MIN_LINE_DOCUMENTS}
     AND count(DISTINCT k.t) * count(DISTINCT k.t) >= host_documents),
left_over AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, CAST(sum(length(k.key)) AS BIGINT) AS n_line_chars,
         CAST(coalesce(sum(length(k.key)) FILTER (WHERE m.key IS NULL), 0) AS BIGINT) AS n_chars_left,
         count(m.key) AS n_template_lines
  FROM keyed k LEFT JOIN template m ON k.key = m.key AND k.source IS NOT DISTINCT FROM m.source GROUP BY doc_id),
figures AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_chars_left, 0) AS n_chars_left,
         coalesce(n_line_chars, 0) AS n_line_chars, coalesce(n_template_lines, 0) AS n_template_lines
  FROM texts LEFT JOIN counts USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN left_over USING (doc_id)),
judged AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words
            AS base_failed FROM figures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT 100 * n_chars_left < {quality_rules.MIN_LEFT_PERCENT} * n_line_chars AS kept,
       n_chars_left, n_line_chars, n_template_lines
FROM judged"""


def _url_filter() -> str:
    rules = ", ".join(
        f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for r, v in url_filter.RULES
    )
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    restart = url_filter.RESTART_PERCENT
    link = url_filter.LINK.replace("'", "''")
    parts = [
        f"rules AS (SELECT * FROM (VALUES {rules}) r(rule, rule_host, rule_path, verdict))",
        """rest AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END
                  AS rest FROM pages)""",
        f"""split AS (SELECT page_id, html, {lower("coalesce(regexp_extract(rest, '^[^/?#]*', 0), '')")} AS host,
                  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest)""",
        """fits AS (SELECT page_id, host, path, rule, verdict,
                  row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) AS place
                  FROM split LEFT JOIN rules ON host <> '' AND (host = rule_host OR ends_with(host, '.' || rule_host))
                       AND starts_with(path, rule_path))""",
        "ruled AS (SELECT page_id, host, path, rule, verdict FROM fits WHERE place = 1)",
        f"""links AS (SELECT DISTINCT host AS u, v FROM
                  (SELECT host, {lower("unnest(regexp_extract_all(coalesce(html, ''), '" + link + "', 1))")} AS v FROM split)
                  WHERE host <> '' AND host <> v)""",
        "edges AS (SELECT u, v, count(*) OVER (PARTITION BY u) AS degree FROM links)",
        f"""nodes AS (SELECT host, max(allow) AS allow, max(block) AS block FROM (
                  SELECT host, count(*) FILTER (WHERE verdict = 'allow') * {url_filter.UNIT} // count(*) AS allow,
                         count(*) FILTER (WHERE verdict = 'block') * {url_filter.UNIT} // count(*) AS block
                  FROM ruled WHERE host <> '' GROUP BY host UNION ALL SELECT v, 0, 0 FROM edges) GROUP BY host)""",
        # every host also has a way to itself that carries nothing, so that it is there in each round
        "ways AS (SELECT u, v, degree FROM edges UNION ALL SELECT host, host, NULL FROM nodes)",
        f"""trusting AS (SELECT 0 AS i, host, CAST(allow * {restart} // 100 AS BIGINT) AS score FROM nodes
                  UNION ALL SELECT i + 1, host, CAST(allow * {restart} // 100 + received // 100 * {100 - restart} AS BIGINT)
                  FROM (SELECT i, w.v AS host, coalesce(sum(score // degree), 0) AS received FROM trusting t
                        JOIN ways w ON w.u = t.host WHERE i < {url_filter.ROUNDS} GROUP BY i, w.v) JOIN nodes USING (host))""",
        f"""known AS (SELECT host, block, least({url_filter.UNIT}, score * 100 // {restart}) AS trust
                  FROM trusting JOIN nodes USING (host) WHERE i = {url_filter.ROUNDS})""",
        f"""distrusting AS (SELECT 0 AS i, host, CAST(block AS BIGINT) AS score FROM known
                  UNION ALL SELECT i + 1, host, CAST(block + ({url_filter.UNIT} - block) * share // {url_filter.UNIT}
                                                     * {100 - restart} // 100 AS BIGINT)
                  FROM (SELECT i, w.u AS host, coalesce(sum(CASE WHEN degree IS NOT NULL THEN greatest(score - trust, 0) END)
                               // max(degree), 0) AS share FROM distrusting d JOIN known USING (host)
                        JOIN ways w ON w.v = d.host WHERE i < {url_filter.ROUNDS} GROUP BY i, w.u) JOIN known USING (host))""",
    ]
    return f"""WITH RECURSIVE {", ".join(parts)},
bad AS (SELECT host FROM distrusting JOIN known USING (host)
        WHERE i = {url_filter.ROUNDS} AND score >= {url_filter.THRESHOLD} AND score > trust)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' END, 'allow') AS verdict
FROM ruled"""


URL_FILTER = _url_filter()

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format

SOURCE_AUDIT = f"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT doc_id, lang, source, {LOWER("unnest(regexp_extract_all(t, '" + source_audit.TERM + "'))")} AS term FROM texts),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc_id) >= {source_audit.MIN_DOCUMENTS}),
counted AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term
  GROUP BY w.lang, w.source, w.term),
groups AS (SELECT DISTINCT lang, source FROM texts),
totals AS (
  SELECT g.lang, g.source, coalesce(c.total, 0) AS total, coalesce(v.terms, 0) AS terms FROM groups g
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counted GROUP BY lang, source) c ON c.lang = g.lang AND c.source = g.source
  LEFT JOIN (SELECT lang, count(*) AS terms FROM kept GROUP BY lang) v ON v.lang = g.lang),
shares AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
         1 + (CAST({source_audit.UNIT} AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (t.total + t.terms) AS p
  FROM totals t JOIN kept k ON k.lang = t.lang
  LEFT JOIN counted c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
whole AS (
  SELECT lang, term, 1 + (CAST({source_audit.UNIT} AS HUGEINT) * (n + 1)) // (sum(n) OVER l + count(*) OVER l) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM counted GROUP BY lang, term) WINDOW l AS (PARTITION BY lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
             FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
             GROUP BY x.lang, x.source, y.source) s ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
terms AS (
  SELECT s.lang, s.source, s.term AS item, (s.p - w.q) * (s.p - w.q) // w.q AS value
  FROM shares s JOIN whole w ON w.lang = s.lang AND w.term = s.term WHERE s.n > 0 AND s.p > w.q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= {source_audit.TOP_TERMS}"""

#: CRC-32 by its table, which the polynomial gives; words are hashed once each.
IMPORTANCE = f"""
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS steps FROM range(256) r(i)),
words AS (
  SELECT doc_id, unnest(regexp_extract_all({LOWER("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM documents),
aims AS (SELECT unnest(regexp_extract_all({LOWER("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark),
vocabulary AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM words UNION SELECT word FROM aims)),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2),
           lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)])), 4294967295) % {importance.BUCKETS} AS bucket
  FROM vocabulary, crc_table),
own AS (SELECT bucket, count(*) AS s FROM words JOIN hashed USING (word) GROUP BY bucket),
aim AS (SELECT bucket, count(*) AS t FROM aims JOIN hashed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM words) + {importance.BUCKETS})
         / ((s + 1.0::DOUBLE) * ((SELECT count(*) FROM aims) + {importance.BUCKETS})))) AS BIGINT) AS gain
  FROM own LEFT JOIN aim USING (bucket)),
weighted AS (
  SELECT doc_id, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
         (CAST('0x' || substr(sha256('{importance.SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM (SELECT doc_id FROM documents) LEFT JOIN weighted USING (doc_id)),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_features >= {importance.MIN_WORDS})
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= {importance.PERCENT} * n // 100 THEN rank END AS rank
FROM scored s LEFT JOIN drawn d ON s.doc_id = d.doc_id"""
