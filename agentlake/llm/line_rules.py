"""Line-first cleaning, with DataFrame functions only.

Each line of a document is judged by itself: a line that is mostly signs, a navigation bar, a stub without an end mark
or a known boilerplate phrase fails and is removed. A document is rejected when too much of its text was in such lines,
or when it fails the base rules (too few words, too many words in repeated three-word windows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.llm.rows import without

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed values of the line rules.
#: More symbols than this share of the line's words, in hundredths.
LINE_SYMBOLS = 100
#: As many separators as this share of the line's words, in hundredths, and at least so many.
LINE_BARS, LEAST_BARS = 25, 3
#: More double exclamation marks than this share of the line's words, in hundredths.
LINE_SHOUTS = 33
#: A line of fewer words needs an end mark.
STUB_WORDS = 4
END_MARK = r"[.!?:;,\x{2026}\"')\]\x{201D}\x{00BB}][\x20\x09-\x0D]*$"
BAR = r"[|\x{00BB}\x{203A}\x{2022}\x{00B7}]"
BOILERPLATE = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy", "we use cookies", "enable javascript",
    "javascript is disabled", "subscribe to our newsletter", "click here to", "sign up for", "share this page", "share this article",
    "back to top", "skip to content", "skip to main content", "released under the", "licensed under the", "spdx-license-identifier",
)
#: Lines of more words are paragraphs, which may speak of such things.
BOILERPLATE_WORDS = 30
#: A document is rejected when more than this part of its word characters was in failing lines, in hundredths.
MOST_LOST = 50
#: Base rules.
LEAST_WORDS, MOST_REPEATED = 50, 50

RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars", "clean_text"]


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACES, ""))


def _total(lines: str, field: str) -> Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + x[field])


def line_fails(line: Column, words: Column, signs: Column) -> Column:
    """Whether one line, of so many words and symbols, is to be removed. A line without words never fails."""
    bars = _count(line, BAR)
    shouts = (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
    phrase, folded = F.lit(False), F.translate(line, UPPER, LOWER)
    for known in BOILERPLATE:
        phrase = phrase | F.contains(folded, F.lit(known))
    return (words > 0) & (
        (100 * signs > LINE_SYMBOLS * words)
        | (100 * shouts > LINE_SHOUTS * words)
        | ((words < STUB_WORDS) & (_count(line, END_MARK) == 0))
        | ((bars >= LEAST_BARS) & (100 * bars >= LINE_BARS * words))
        | ((words <= BOILERPLATE_WORDS) & phrase)
    )


def judge_lines(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns of ``docs`` (or those of ``keep``) with the verdict and its grounds.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word that equal an earlier line),
    n_repeat_words (words in three-word windows found at least twice, the first included), base_failed, kept,
    lost_chars (word characters in removed lines) and clean_text (the other lines, joined by line feeds); they replace
    input columns of these names. A null text counts as empty: no words, so base_failed. Rows are judged one by one, so
    equal rows get equal results. Lines end at a line feed; a carriage return before it belongs to the line, as space.
    """
    docs = without(docs, RESULTS)
    keep = [c for c in (keep or docs.columns) if c.lower() not in RESULTS]
    text = F.coalesce(F.col("text"), F.lit(""))
    # every step names its arrays, so that no later function computes them again
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(
        x.alias("line"), _count(x, WORD).alias("words"), _word_chars(x).alias("chars"), (F.length(x) - F.length(F.translate(x, SYMBOLS, ""))).alias("signs")))
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), text.alias("text"))
    row = row.select("row", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"), lines.alias("lines"))
    good = F.filter("lines", lambda x: ~line_fails(x["line"], x["words"], x["signs"]))
    row = row.select("row", "words", "lines", good.alias("good"))
    window = F.when(F.size("words") < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.slice("words", F.lit(1), F.size("words") - 2), lambda x, i: F.xxhash64(x, F.get("words", i + 1), F.get("words", i + 2))))
    filled = F.transform(F.filter("lines", lambda x: x["words"] > 0), lambda x: x["line"])
    row = row.select(
        "row", F.size("words").cast("long").alias("n_words"), _total("lines", "chars").alias("word_chars"), _total("lines", "signs").alias("n_symbols"),
        (F.size(filled) - F.size(F.array_distinct(filled))).cast("long").alias("n_dup_lines"),
        (_total("lines", "chars") - _total("good", "chars")).alias("lost_chars"),
        F.array_join(F.transform("good", lambda x: x["line"]), "\n").alias("clean_text"), window.alias("windows"))
    row = row.withColumn("sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    again = F.filter("sorted", lambda x, k: (F.get("sorted", k - 1)["h"] == x["h"]) | (F.get("sorted", k + 1)["h"] == x["h"]))
    # get() outside of the array gives null, which counts as different
    row = row.withColumn("places", F.sort_array(F.transform(again, lambda x: x["i"])))
    steps = F.zip_with("places", F.slice("places", 2, F.greatest(F.size("places") - 1, F.lit(0))), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    row = row.withColumn("n_repeat_words", F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)))
    row = row.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    row = row.withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= MOST_LOST * F.col("word_chars")))
    return row.select("row.*", *RESULTS)


_SQL_PHRASES = " OR ".join(f"contains(translate(x, '{UPPER}', '{LOWER}'), '{known}')" for known in BOILERPLATE)
_SQL_LINE = f"""(len(regexp_extract_all(x, '{WORD}')) > 0 AND (
    100 * (length(x) - length(translate(x, '{SYMBOLS}', ''))) > {LINE_SYMBOLS} * len(regexp_extract_all(x, '{WORD}'))
    OR 100 * len(regexp_extract_all(x, '!!')) > {LINE_SHOUTS} * len(regexp_extract_all(x, '{WORD}'))
    OR (len(regexp_extract_all(x, '{WORD}')) < {STUB_WORDS} AND NOT regexp_matches(x, '{END_MARK.replace("'", "''")}'))
    OR (len(regexp_extract_all(x, '{BAR}')) >= {LEAST_BARS} AND 100 * len(regexp_extract_all(x, '{BAR}')) >= {LINE_BARS} * len(regexp_extract_all(x, '{WORD}')))
    OR (len(regexp_extract_all(x, '{WORD}')) <= {BOILERPLATE_WORDS} AND ({_SQL_PHRASES}))))"""

ORACLE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT *, regexp_extract_all(text, '{WORD}') AS words, string_split(text, chr(10)) AS lines FROM docs),
counted AS (
  SELECT r, doc_id, words, len(words) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
         length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols,
         list_filter(lines, lambda x: len(regexp_extract_all(x, '{WORD}')) > 0) AS filled,
         list_filter(lines, lambda x: {_SQL_LINE}) AS failing
  FROM parts),
windows AS (
  SELECT r, unnest(list_transform(range(1, n_words - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS g,
         unnest(range(1, n_words - 1)) AS i
  FROM counted WHERE n_words >= 3),
again AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows),
repeated AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) AS t(k) WHERE n >= 2 GROUP BY r),
judged AS (
  SELECT c.*, coalesce(n_repeat_words, 0) AS n_repeat,
         coalesce(list_sum(list_transform(failing, lambda x: length(regexp_replace(x, '[\\x20\\x09-\\x0D]+', '', 'g')))), 0) AS lost_chars
  FROM counted c LEFT JOIN repeated USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(len(filled) - len(list_distinct(filled)) AS BIGINT) AS n_dup_lines, CAST(n_repeat AS BIGINT) AS n_repeat_words,
       (n_words < {LEAST_WORDS} OR 100 * n_repeat > {MOST_REPEATED} * n_words) AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat > {MOST_REPEATED} * n_words) AND 100 * lost_chars <= {MOST_LOST} * word_chars AS kept
FROM judged
"""
