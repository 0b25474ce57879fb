"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Targets are one level for all sources that are not full; ranks follow size, then a hash of the id.
ORACLES["op8_systematic_mix"] = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS draw
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source = '', source) - 1) % 3 + 1)::INT] AS weight FROM sources
), filled AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS full_at FROM weighed
), leveled AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM filled)
             - 2.0::DOUBLE * coalesce((SELECT sum(b.source_size) FROM filled b WHERE b.full_at < a.full_at), 0))
            / ((SELECT sum(weight) FROM filled) - coalesce((SELECT sum(b.weight) FROM filled b WHERE b.full_at < a.full_at), 0)) AS own_level
  FROM filled a
), first AS (
  SELECT min(full_at) AS first_at, arg_min(own_level, full_at) AS level FROM leveled WHERE own_level < full_at
), targets AS (
  SELECT source, source_size, CASE WHEN (SELECT first_at FROM first) IS NULL OR full_at < (SELECT first_at FROM first)
         THEN 2.0::DOUBLE * source_size ELSE (SELECT level FROM first) * weight END AS target,
         ('0x' || substr(md5('24|' || source), 1, 15))::BIGINT / 1152921504606846976.0::DOUBLE AS start
  FROM leveled
), ranked AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.start,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
         (row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.draw, s.doc_id))::DOUBLE AS r
  FROM sized s JOIN targets t USING (source)
), counted AS (
  SELECT *, least(floor(rate * r + start) - floor(rate * (r - 1.0::DOUBLE) + start), ceil(rate))::BIGINT AS copies FROM ranked
)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM counted
"""

# The template of ``chat_format.py``: three marks, and a backslash before each of their first characters in a text.
ORACLES["op11_prefix_target_chat"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), formed AS (
  SELECT *, length('### ' || replace(regexp_replace(role, '([\\#<])', '\\\1', 'g'), ':', '\.') || ': '
                   || regexp_replace(text, '([\\#<])', '\\\1', 'g') || '</turn>' || chr(10)) AS chars FROM turns
), placed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS so_far FROM formed
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, count(*) FILTER (role = 'assistant') AS n_examples,
  coalesce(sum(so_far) FILTER (role = 'assistant'), 0)::BIGINT AS examples_chars
FROM placed GROUP BY conv_id
"""

ORACLES["op12_stripe_phrases"] = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents))
  WHERE len(words) > 0
), grams AS (
  SELECT lang, m, array_to_string(words[i : i + m - 1], ' ') AS phrase
  FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(words) >= m)
), counts AS (
  SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND a >= 30
), inner_phrases AS (
  SELECT lang, a, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, a, w, k, unnest(range(1, m - k + 2)) AS i FROM candidates, (SELECT unnest([2, 3]) AS k) WHERE k < m)
), around AS (
  SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, array_to_string(w[1 : k], ' ') AS first, array_to_string(w[k + 1 : m], ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c LEFT JOIN around USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * c.a::HUGEINT
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, f.a AS l, g.a AS r, ((2000000 * c.a::HUGEINT) // (f.a + g.a)::HUGEINT)::BIGINT AS score
  FROM cuts c JOIN counts f ON f.lang = c.lang AND f.phrase = first JOIN counts g ON g.lang = c.lang AND g.phrase = rest
), worst AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst) JOIN totals USING (lang)
WHERE rank <= 2000
"""
