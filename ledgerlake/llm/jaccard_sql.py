"""DuckDB SQL shared by the operators that link documents by word n-grams."""


def jaccard_sql(width: int, percent: int) -> str:
    """DuckDB CTEs ``sets`` (doc_id, s) and ``reach`` (doc_id, component_id) of links between sets of word n-grams."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - {width - 2}),
                                                        lambda k: array_to_string(w[k:k + {width - 1}], ' '))) END AS s
  FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM members a JOIN members b ON a.g = b.g AND a.doc_id < b.doc_id
   AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
edges AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
walk AS (
  SELECT DISTINCT u AS doc_id, u AS seen FROM edges
  UNION
  SELECT walk.doc_id, edges.v FROM walk JOIN edges ON edges.u = walk.seen),
reach AS (
  SELECT sets.doc_id, len(s) AS n_shingles, coalesce(min(seen), sets.doc_id) AS component_id
  FROM sets LEFT JOIN walk USING (doc_id) GROUP BY sets.doc_id, len(s))"""
