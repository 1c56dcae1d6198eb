"""DuckDB SQL of the operators that SQL can express."""

FILTER_AUDIT = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM texts),
said AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part,
    concat(CASE WHEN len(w) < 100 THEN 'A' ELSE '' END,
           CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END,
           CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END,
           CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
           CASE WHEN words.doc_id > least THEN 'E' ELSE '' END) AS fails,
    count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM words LEFT JOIN said USING (doc_id) GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT concat(a.l, b.l, c.l, d.l, e.l) AS filter_order
  FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l)
  JOIN letters d ON d.l NOT IN (a.l, b.l, c.l) JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS l, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
counted AS (
  SELECT part, filter_order, step, l,
    coalesce(sum(n) FILTER (translate(concat(earlier, l), fails, '') = concat(earlier, l)), 0) AS kept,
    coalesce(sum(n) FILTER (contains(fails, l) AND translate(earlier, fails, '') = earlier), 0) AS removed,
    coalesce(sum(n) FILTER (contains(fails, l) AND translate(earlier, fails, '') <> earlier), 0) AS redundant,
    coalesce(sum(n) FILTER (fails = l), 0) AS unique_fails,
    coalesce(sum(good) FILTER (contains(fails, l) AND translate(earlier, fails, '') = earlier), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (contains(fails, l) AND translate(earlier, fails, '') = earlier), 0) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, l)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
FROM counted
"""

LEXICAL_SEARCH = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
whole AS (SELECT count(*) AS nd, sum(len(terms)) AS nl FROM docs WHERE len(terms) > 0),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (
  SELECT r, doc_id, n, term, count(*) AS f
  FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, whole GROUP BY term),
scores AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * f) // (1000 * f + 8 * (10 + (90 * n * nd) // nl)))) AS BIGINT) AS score
  FROM items JOIN tf USING (term) JOIN weights USING (term), whole GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
