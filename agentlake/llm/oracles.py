"""The queries as DuckDB SQL, where SQL can express them. The searches compare whole windows as texts."""

from __future__ import annotations

from agentlake.llm import line_rules, mixing
from agentlake.llm.line_rules import LOWER, UPPER, WORD

ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATE = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALPHANUMERIC}') AS w FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALPHANUMERIC}') AS w FROM benchmark),
patterns AS (
  SELECT item, least(len(w), 10) AS n,
         unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS g
  FROM b WHERE len(w) > 0),
sizes AS (
  SELECT DISTINCT n FROM patterns),
windows AS (
  SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g,
         unnest(range(1, len(w) - n + 2)) AS i
  FROM d, sizes WHERE len(w) >= n),
hits AS (
  SELECT DISTINCT doc_id, i, n, item FROM windows JOIN patterns USING (n, g)),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SUBSTRING_DEDUP = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) AS g, unnest(range(1, len(w) - 18)) AS i
  FROM d WHERE len(w) >= 20),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS turn FROM windows) WHERE turn > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM later),
words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id),
lost AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

JACCARD_JOIN = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
  FROM d WHERE len(w) > 0),
sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
sides AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, s.y FROM reached r JOIN sides s ON r.other = s.x)
SELECT r.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM reached r LEFT JOIN sizes USING (doc_id) GROUP BY r.doc_id
"""

#: The letters beyond a to z are the code points U+00C0 to U+00FF, two bytes each. crc32 goes through the bytes by a table.
SPELLING = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00c0-\u00ff]{{5,}}')), '{UPPER}', '{LOWER}') AS run FROM documents),
counted AS (
  SELECT doc_id, run, count(*) AS k FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
           lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, CAST(unicode(x) AS BIGINT) - 64] END))),
           lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)]))) AS h
  FROM counted, crc),
results AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, k FROM hashed),
words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM results WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
places AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
hidden AS (
  SELECT word, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS key FROM places),
shorter AS (
  SELECT DISTINCT p.word AS long, w.word AS short FROM places p JOIN words w ON w.word = substr(p.word, 1, p.i - 1) || substr(p.word, p.i + 1)),
near AS (
  SELECT a.word, b.word AS other FROM hidden a JOIN hidden b ON a.key = b.key AND a.word <> b.word
  UNION ALL SELECT long, short FROM shorter UNION ALL SELECT short, long FROM shorter),
ranked AS (
  SELECT near.word, other, n, count(*) OVER (PARTITION BY near.word) AS n_near, row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS turn
  FROM near JOIN words ON words.word = other),
formed AS (
  SELECT w.word, CASE WHEN r.n >= 2 * w.n THEN other END AS form, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN r.n >= 2 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND turn = 1),
walk(word, root) AS (
  SELECT word, word FROM formed UNION ALL SELECT walk.word, form FROM walk JOIN formed ON formed.word = root WHERE form IS NOT NULL)
SELECT f.word, f.form, root, f.n, f.n_near, f.form_n
FROM walk JOIN formed f ON f.word = walk.word JOIN formed last ON last.word = root WHERE last.form IS NULL
"""

ORACLES = {
    "op11_spelling": SPELLING,
    "op3_decontaminate": DECONTAMINATE,
    "op4_substring_dedup": SUBSTRING_DEDUP,
    "op6_line_rules": line_rules.ORACLE,
    "op7_jaccard_join": JACCARD_JOIN,
    "op9_mix_sources": mixing.ORACLE,
}
