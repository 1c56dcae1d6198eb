"""SQL twins of byte-level words and byte-pair learning, for the query checks."""

from __future__ import annotations

from shardweave.functions.bytelevel import BYTE_TO_CHAR

# RE2 has no look-ahead: a mark is set before the last blank of each run first.
_PATTERN = (r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+"
            r"| ?[^\s\p{L}\p{N}\x01]+|\s+")


def words_sql(text: str) -> str:
    marked = (rf"regexp_replace(CASE WHEN starts_with({text}, ' ') THEN {text} ELSE ' ' || {text} END,"
              r" '(\s)(\s\S)', '\1' || chr(1) || '\2', 'g')")
    return f"regexp_extract_all({marked}, '{_PATTERN}')"


_BYTES = "[" + ", ".join(
    "'" + BYTE_TO_CHAR[b].replace("'", "''") + "'" for b in range(256)) + "]"


def byte_chars_sql(word: str) -> str:
    """List of byte characters of a word."""
    return (f"list_transform(range(octet_length(encode({word}))), lambda i: {_BYTES}["
            f"('0x' || substr(hex(encode({word})), 2 * i::BIGINT + 1, 2))::INTEGER + 1])")


SQL_WORDS = f"""
wc AS MATERIALIZED (
  SELECT word, count(*) AS n FROM (SELECT unnest({words_sql('text')}) AS word FROM documents)
  GROUP BY word),
spelled AS MATERIALIZED (
  SELECT word, n, chr(2) || array_to_string({byte_chars_sql('word')}, chr(3) || chr(2)) || chr(3) AS w
  FROM wc),
letters AS MATERIALIZED (
  SELECT ch, 2 + row_number() OVER (ORDER BY encode(ch)) AS id
  FROM (SELECT DISTINCT unnest({byte_chars_sql('word')}) AS ch FROM wc))"""


def pairs_sql(state: str) -> str:
    """Adjacent symbols of wrapped words in ``state(w, n)``, weighted."""
    return f"""
  SELECT s[i] AS l, s[i + 1] AS r, sum(n)::BIGINT AS c
  FROM (SELECT s, n, unnest(range(1, len(s))) AS i
        FROM (SELECT string_split(substr(w, 2, length(w) - 2), chr(3) || chr(2)) AS s, n
              FROM {state}) WHERE len(s) > 1)
  GROUP BY ALL"""


def learnt_sql(tokens: int) -> str:
    """CTEs ``rounds`` (words and tokens after each merge), ``final`` and ``tokens``.

    One recursion step is one merge: the most frequent pair, ties to the smaller ids.
    Merging stops when there are ``tokens`` tokens, the three specials included.
    """
    return f"""
rounds(kind, w, n, word, step) AS (
  SELECT 'w', w, n, word, 0 FROM spelled
  UNION ALL SELECT 't', ch, id, NULL, 0 FROM letters
  UNION ALL (
    WITH cur AS MATERIALIZED (SELECT * FROM rounds),
    pairs AS ({pairs_sql("(SELECT w, n FROM cur WHERE kind = 'w')")}),
    best AS MATERIALIZED (
      SELECT l, r FROM pairs JOIN cur a ON a.kind = 't' AND a.w = l
                             JOIN cur b ON b.kind = 't' AND b.w = r
      WHERE (SELECT count(*) FROM cur WHERE kind = 't') < {tokens - 3}
      ORDER BY c DESC, a.n, b.n LIMIT 1),
    next AS MATERIALIZED (
      SELECT l, r, max(n) + 1 AS id, max(step) + 1 AS step
      FROM best, (SELECT n, step FROM cur WHERE kind = 't') GROUP BY l, r)
    SELECT kind,
           CASE WHEN kind = 'w' THEN replace(w, chr(2) || l || chr(3) || chr(2) || r || chr(3),
                                             chr(2) || l || r || chr(3)) ELSE w END,
           n, word, step + 1
    FROM cur, best
    UNION ALL SELECT 'm', l || chr(1) || r, id, NULL, step FROM next
    UNION ALL SELECT 't', l || r, id, NULL, step FROM next)),
final AS MATERIALIZED (
  SELECT kind, w, n, word FROM rounds WHERE step = (SELECT max(step) FROM rounds)),
tokens AS MATERIALIZED (
  SELECT n::INTEGER AS id, w AS token, CASE WHEN length(w) = 1 THEN 'byte' ELSE 'merged' END AS kind
  FROM final WHERE kind = 't'
  UNION ALL VALUES (0, '[UNK]', 'special'), (1, '[BOS]', 'special'), (2, '[EOS]', 'special')),
merges AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY n) - 1)::INTEGER AS rank,
         split_part(w, chr(1), 1) AS "left", split_part(w, chr(1), 2) AS "right"
  FROM final WHERE kind = 'm')"""


SQL_ENCODED_WORDS = """
word_syms AS (
  SELECT word, unnest(s) AS sym, generate_subscripts(s, 1) AS pos
  FROM (SELECT word, string_split(substr(w, 2, length(w) - 2), chr(3) || chr(2)) AS s
        FROM final WHERE kind = 'w')),
coded AS MATERIALIZED (
  SELECT word, list(id ORDER BY pos) AS ids FROM word_syms JOIN tokens ON token = sym
  GROUP BY word)"""

SQL_ENCODED_DOCS = f"""
doc_words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
  FROM (SELECT doc_id, {words_sql('text')} AS ws FROM documents)),
doc_ids AS (
  SELECT doc_id, flatten(list(ids ORDER BY pos)) AS ids
  FROM doc_words JOIN coded USING (word) GROUP BY doc_id)"""
