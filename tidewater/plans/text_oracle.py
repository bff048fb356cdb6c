"""DuckDB oracle SQL of the word-count queries (independent of the Spark code)."""

# Lines: a line reader's split on \r\n, \r or \n; no line after a final
# terminator; empty text has none. Words: split on one space, trailing empty
# words dropped, a line without a space is itself one word.
_LINES = r"""
  unnest(CASE WHEN {t} = '' THEN []::VARCHAR[]
              ELSE regexp_split_to_array(regexp_replace({t}, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n')
         END)"""
_WORDS = r"""
  unnest(CASE WHEN position(' ' IN {l}) = 0 THEN [{l}]
              WHEN rtrim({l}, ' ') = '' THEN []::VARCHAR[]
              ELSE string_split(rtrim({l}, ' '), ' ')
         END)"""

DENY = "('a', 'b', 'c')"

DOC_WORDS = f"""
doc_lines AS (SELECT {_LINES.format(t='text')} AS line FROM documents),
doc_words AS (SELECT {_WORDS.format(l='line')} AS word FROM doc_lines)"""

CONV_WORDS = f"""
conv_lines AS (SELECT turn AS batch_id, {_LINES.format(t='text')} AS line FROM conversations),
conv_words AS (SELECT batch_id, {_WORDS.format(l='line')} AS word FROM conv_lines),
conv_counts AS (SELECT batch_id, word, count(*) AS cnt FROM conv_words GROUP BY batch_id, word)"""

ORACLE = {
    "wordcount_documents": f"""
WITH {DOC_WORDS}
SELECT word, count(*) AS cnt FROM doc_words
WHERE word NOT IN {DENY} GROUP BY word""",

    "dropped_words_total": f"""
WITH {DOC_WORDS}
SELECT CAST(count(*) AS BIGINT) AS dropped,
       'Dropped ' || CAST(count(*) AS VARCHAR) || ' word(s) totally' AS report
FROM doc_words WHERE word IN {DENY}""",

    "wordcount_per_batch": f"""
WITH {CONV_WORDS}
SELECT batch_id, word, cnt FROM conv_counts WHERE word NOT IN {DENY}""",

    "dropped_running_total": f"""
WITH {CONV_WORDS},
per_batch AS (
  SELECT batch_id, CAST(coalesce(sum(cnt) FILTER (WHERE word IN {DENY}), 0) AS BIGINT) AS dropped
  FROM conv_counts GROUP BY batch_id)
SELECT batch_id, dropped,
       CAST(sum(dropped) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS dropped_total,
       'Dropped ' || CAST(CAST(sum(dropped) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS VARCHAR) || ' word(s) totally' AS report
FROM per_batch""",

    "camel_to_snake": r"""
SELECT c_custkey, c_name,
       CASE WHEN c_name = '' THEN ''
            ELSE array_to_string(list_transform(string_split(c_name, ''),
                   lambda ch: CASE WHEN upper(ch) = ch AND NOT regexp_matches(ch, '^[0-9]$')
                                   THEN '_' || lower(ch) ELSE lower(ch) END), '')
       END AS column_name
FROM customer""",

    "batch_report": f"""
WITH {CONV_WORDS},
per_batch AS (
  SELECT batch_id, coalesce(sum(cnt) FILTER (WHERE word IN {DENY}), 0) AS dropped
  FROM conv_counts GROUP BY batch_id)
SELECT batch_id, 0 AS section, CAST(NULL AS VARCHAR) AS word,
       'Counts at time ' || CAST(batch_id AS VARCHAR) || ' [' AS line FROM per_batch
UNION ALL
SELECT batch_id, 1, word, '(' || word || ',' || CAST(cnt AS VARCHAR) || ')'
FROM conv_counts WHERE word NOT IN {DENY}
UNION ALL
SELECT batch_id, 2, NULL, ']' FROM per_batch
UNION ALL
SELECT batch_id, 3, NULL, 'Dropped '
       || CAST(CAST(sum(dropped) OVER (ORDER BY batch_id) AS BIGINT) AS VARCHAR)
       || ' word(s) totally' FROM per_batch""",
}
