"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from .licenses import TEMPLATES, need_of, width_of, words_of

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op9_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), marked AS (
  SELECT *, role IS DISTINCT FROM lag(role) OVER w AS opens, role IS DISTINCT FROM lead(role) OVER w AS closes,
         regexp_replace(regexp_replace(text, '<(\\*)(/turn|and/)>', '<\\\1\2>', 'g'),
                        '###(\\*) ', '###\\\1 ', 'g') AS body
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(length(body) + CASE WHEN opens THEN length(CASE role WHEN 'user' THEN 'User' WHEN 'system' THEN 'System'
                    WHEN 'assistant' THEN 'Assistant' ELSE 'Other ' || role END) + 6 ELSE 6 END
                + CASE WHEN closes THEN 8 ELSE 0 END) AS BIGINT) AS formatted_chars,
       count(*) FILTER (WHERE opens) AS n_merged
FROM marked GROUP BY conv_id
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TEMPLATE_ROWS = ",\n    ".join(
    f"({i}, {_text(t.label)}, {str(t.base).lower()}, {str(t.consecutive).lower()}, {need_of(t)}, {width_of(t)}, "
    f"[{', '.join(map(_text, words_of(t.text)))}])" for i, t in enumerate(TEMPLATES))

# Every template against every block, without any filter.
ORACLE_SQL["op11_license_scan"] = rf"""
WITH template(number, label, base, consecutive, need, width, words) AS (VALUES
    {_TEMPLATE_ROWS}
), own AS (
  SELECT DISTINCT number, need, width, unnest(words) AS word FROM template
), text AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), hit AS (
  SELECT * FROM (SELECT row_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM text)
  WHERE word IN (SELECT word FROM own)
), shared AS (
  SELECT row_id, number, place // (width // 2) - early AS block, count(DISTINCT word) AS n
  FROM hit JOIN own USING (word), (VALUES (0), (1)) AS e(early)
  WHERE place // (width // 2) >= early
  GROUP BY ALL HAVING count(DISTINCT word) >= any_value(need)
), loose AS (
  SELECT row_id, number, label, base, NULL AS place, n / len(list_distinct(words)) AS score
  FROM shared JOIN template USING (number) WHERE NOT consecutive
), strict AS (
  SELECT row_id, number, label, base, place, 1.0 AS score
  FROM hit JOIN template t ON t.consecutive AND hit.word = t.words[1] JOIN text USING (row_id)
  WHERE text.words[place + 1:place + len(t.words)] = t.words
), found AS (
  SELECT row_id, count(*) FILTER (WHERE base) AS n_base, min(place) FILTER (WHERE base) AS first_word,
         max(place) FILTER (WHERE base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM (SELECT * FROM loose UNION ALL SELECT * FROM strict) GROUP BY row_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM text LEFT JOIN found USING (row_id)
"""

ORACLE_SQL["op12_hard_negatives"] = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

# Every n-gram counted by itself.
ORACLE_SQL["op13_collocations"] = rf"""
WITH piece AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
               translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), gram AS (
  SELECT lang, k, array_to_string(words[i + 1:i + k], ' ') AS phrase
  FROM (SELECT lang, words, k, unnest(range(len(words) - k + 1)) AS i FROM piece, range(1, 6) AS s(k)
        WHERE len(words) >= k)
), total AS (
  SELECT lang, count(*) AS n FROM gram WHERE k = 1 GROUP BY lang
), counted AS (
  SELECT lang, k, phrase, count(*) AS n FROM gram GROUP BY ALL HAVING count(*) >= 100
), cut AS (
  SELECT lang, k, phrase, n AS a, c, array_to_string(string_split(phrase, ' ')[1:c], ' ') AS part1,
         array_to_string(string_split(phrase, ' ')[c + 1:], ' ') AS part2
  FROM counted, range(1, 5) AS s(c) WHERE c < k
), scored AS (
  SELECT cut.lang, cut.k, cut.phrase, a, x.n AS l, y.n AS r, total.n AS n,
         (CAST(1000 AS HUGEINT) * a * total.n) // (CAST(x.n AS HUGEINT) * y.n) AS score
  FROM cut JOIN counted x ON x.lang = cut.lang AND x.phrase = part1
           JOIN counted y ON y.lang = cut.lang AND y.phrase = part2 JOIN total ON total.lang = cut.lang
  QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, c) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       CAST(score AS BIGINT) AS score
FROM scored s
WHERE NOT EXISTS (SELECT 1 FROM counted t WHERE t.lang = s.lang AND t.k > s.k AND t.n >= s.a
                    AND contains(' ' || t.phrase || ' ', ' ' || s.phrase || ' '))
QUALIFY rank <= 2000
"""
