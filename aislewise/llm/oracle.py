"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from aislewise.llm import licenses
from aislewise.llm import quality_rules as q

_WORD = r"[^\x20\x09-\x0D]+"
_SPACE = r"[\x20\x09-\x0D]+"
_PHRASES = " OR ".join(f"contains(lower(line), '{p}')" for p in q.BOILERPLATE)
_BARE = r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"
_ENDING = q.ENDING.replace("'", "''")

OP1 = rf"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), doc AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '{_WORD}') AS w,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols
  FROM base
), win AS (
  SELECT r, i, w[i:i + 4] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM doc WHERE len(w) >= 5)
), again AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win
), covered AS (
  SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat_words
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM again WHERE n > 1)
  GROUP BY r
), line AS (
  SELECT r, line
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM doc)
  WHERE regexp_matches(line, '{_WORD}')
), judged AS (
  SELECT r, line, length(regexp_replace(line, '{_SPACE}', '', 'g')) AS chars,
         regexp_matches(line, '{_ENDING}')
         AND (length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g'))) * 100
             <= length(line) * {q.MAX_SYMBOL_PERCENT}
         AND NOT regexp_matches(line, '{q.NAVIGATION}')
         AND NOT (length(line) - length(regexp_replace(line, '[{q.SEPARATORS}]', '', 'g'))
                    >= {q.MIN_SEPARATORS}
                  AND length({_BARE}) - length(regexp_replace({_BARE}, '[ \t]', '', 'g'))
                    <= (length(line) - length(regexp_replace(line, '[{q.SEPARATORS}]', '', 'g'))
                        + 1) * 4)
         AND NOT ({_PHRASES}) AS good
  FROM line
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (NOT good) AS n_lines_removed,
         coalesce(sum(chars) FILTER (NOT good), 0) AS lost_chars
  FROM judged GROUP BY r
), counts AS (
  SELECT doc.doc_id, len(w) AS n_words,
         length(regexp_replace(text, '{_SPACE}', '', 'g')) AS word_chars, n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines_removed, 0) AS n_lines_removed, coalesce(lost_chars, 0) AS lost_chars
  FROM doc LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND lost_chars * 100 <= word_chars * {q.MAX_LOST_PERCENT} AS kept,
       n_lines_removed::BIGINT AS n_lines_removed, lost_chars::BIGINT AS lost_chars
FROM counts
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce({_LOWER}, ''), '{_WORD}') AS w
  FROM documents
), grams AS (
  SELECT r, doc_id, list_distinct(CASE
           WHEN len(w) = 0 THEN []
           WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
         END) AS g
  FROM doc
), sets AS (
  SELECT min(r) AS s, min(doc_id) AS least, any_value(g) AS g, len(any_value(g)) AS n
  FROM grams WHERE len(g) > 0 GROUP BY list_sort(g)
), gram AS (
  SELECT s, n, unnest(g) AS x FROM sets
), link AS (
  SELECT a.s AS u, b.s AS v
  FROM gram a JOIN gram b ON a.x = b.x AND a.s <> b.s AND a.n * 100 >= b.n * 90 AND b.n * 100 >= a.n * 90
  GROUP BY a.s, b.s, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT s AS u, s AS v FROM sets
  UNION
  SELECT reach.u, link.v FROM reach JOIN link ON reach.v = link.u
), smallest AS (
  SELECT u, min(least) AS component_id FROM reach JOIN sets ON sets.s = reach.v GROUP BY u
), of_set AS (
  SELECT list_sort(g) AS g, component_id FROM sets JOIN smallest ON smallest.u = sets.s
)
SELECT doc_id, len(grams.g)::BIGINT AS n_shingles,
       CASE WHEN len(grams.g) = 0 THEN doc_id ELSE component_id END AS component_id
FROM grams LEFT JOIN of_set ON list_sort(grams.g) = of_set.g
"""

OP11 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
         coalesce(source, '') AS source
  FROM documents
), occurrence AS (
  SELECT r, lang, source,
         translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM doc
), kept AS (
  SELECT lang, term, count(*) AS n FROM occurrence GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), used AS (
  SELECT lang, source, term, count(*) AS n FROM occurrence JOIN kept USING (lang, term) GROUP BY ALL
), in_lang AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), in_group AS (
  SELECT lang, source, sum(n) AS total FROM used GROUP BY lang, source
), groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(l.total, 0) AS n_lang,
         coalesce(i.total, 0) AS n_group
  FROM (SELECT DISTINCT lang, source FROM doc) AS g
  LEFT JOIN in_lang AS l USING (lang) LEFT JOIN in_group AS i USING (lang, source)
), dense AS (
  SELECT lang, source, term, coalesce(u.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(u.n, 0) + 1)) // (n_group + v) AS p,
         1 + (1000000000::HUGEINT * (kept.n + 1)) // (n_lang + v) AS q
  FROM groups JOIN kept USING (lang) LEFT JOIN used AS u USING (lang, source, term)
), total AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM dense AS a JOIN dense AS b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN total ON total.lang = a.lang AND total.source = a.source AND total.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM dense WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM found
QUALIFY part = 'pair' OR rank <= 200
"""



def _template_pattern(parts: tuple) -> str:
    """A template as a regular expression over words, each after one space."""
    made = []
    for part in parts:
        if isinstance(part, licenses.Wording):
            made.append(" " + part.word.decode())
        elif isinstance(part, licenses.AnyWords):
            made.append(f"( [^ ]+){{{part.least},{part.most}}}")
        else:
            ways = "|".join(_template_pattern(way) for way in part.ways)
            made.append(f"({ways})" + "?" * part.optional)
    return "".join(made)


_AUTOMATA = [(t, licenses.Automaton(t)) for t in licenses.TEMPLATES]
_TEMPLATE_ROWS = ", ".join(
    f"('{t.label}', '{_template_pattern(licenses.parse_template(t.wording))} ', {a.mandatory})"
    for t, a in _AUTOMATA
)
# Two spaces between words, so that a phrase and the next one share none.
_PHRASE_ROWS = ", ".join(
    f"('{label}', ' {'  '.join(text.split())} ', {len(text.split())})"
    for label, text in licenses.PHRASES.items()
)
OP13 = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), line AS (
  SELECT r, doc_id, len(w) AS n_words, ' ' || array_to_string(w, ' ') || ' ' AS line,
         ' ' || array_to_string(w, '  ') || ' ' AS wide
  FROM doc
), phrase(label, phrase, wording) AS (VALUES {_PHRASE_ROWS}
), template(label, pattern, wording) AS (VALUES {_TEMPLATE_ROWS}
), base AS (
  SELECT r, label, wording, len(split) - 1 AS places,
         (length(split[1]) - length(replace(split[1], ' ', ''))) // 2 AS first_word,
         (length(wide) - length(replace(wide, ' ', ''))) // 2 - wording
           - (length(split[-1]) - length(replace(split[-1], ' ', ''))) // 2 AS last_word
  FROM (SELECT *, string_split(wide, phrase) AS split FROM line JOIN phrase ON contains(wide, phrase))
), quoted AS (
  SELECT r, label, wording FROM line JOIN template ON regexp_matches(line, pattern)
), base_of AS (
  SELECT r, sum(places) AS n_base, min(first_word) AS first_word, max(last_word) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM base GROUP BY r
), all_of AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(wording) AS wording
  FROM (SELECT r, label, wording FROM base UNION ALL SELECT * FROM quoted) GROUP BY r
)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(wording / n_words, 0.0) AS score
FROM line LEFT JOIN base_of USING (r) LEFT JOIN all_of USING (r)
"""

SQL: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op4_ngram_jaccard_join": OP4,
    "op11_source_divergence": OP11,
    "op13_license_scans": OP13,
}
