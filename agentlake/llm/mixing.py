"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Within each source, documents stand in the order of their keys, and a document is
taken as far as the running sum of sizes stays within the source's budget. The running sums are distributed: keys are
cut into as many ranges as the square root of the number of documents, totals of the ranges are summed up first, and each
(source, range) is then sorted and summed by itself. So no task holds a source, however large, and the order is the same
in every run.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agentlake.llm.rows import without
from agentlake.llm.storage import materialize

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
RESULTS = ["size", "source_size", "target", "taken"]


def source_targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Targets of sources (one row each: ``no_source``, ``source_key``, ``source_size``).

    Sources in code-point order, the null source last, get the weights in turn. ``share`` times all sizes is shared by
    weight; a target stops at ``most`` times its source's size, and what is left over is shared among the others by
    weight until none is above. That is filling to one level: the target is the smaller of cap and level times weight.
    Ordered by cap per weight, the level is the largest of (budget - caps before) / (weights from here on).
    """
    by_name = Window.orderBy("no_source", "source_key")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))
    ranked = sources.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "no_source", "source_key")
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    caps, used = (F.coalesce(F.sum(c).over(before), F.lit(0.0)) for c in ("cap", "weight"))
    whole = ranked.select("*", (F.lit(float(share)) * F.sum("source_size").over(all_rows)).alias("budget"), F.sum("weight").over(all_rows).alias("all_weights"))
    stepped = whole.withColumn("step", (F.col("budget") - caps) / (F.col("all_weights") - used))
    level = F.max("step").over(all_rows)
    return stepped.select("no_source", "source_key", "source_size", F.least("cap", level * F.col("weight")).alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """How many words of each document the mix takes.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; its columns are returned with ``size`` (words), ``source_size``,
    ``target`` (of the source) and ``taken`` (words; repeats count), in place of input columns of these names. A source
    whose target exceeds its size is taken whole as often as it fits, then its documents once more in the order of their
    keys up to the budget, the target rounded to words; the document at the cut gives the words that still fit. No
    document exceeds ``most`` times its size.

    A null or empty text has size 0 and gives nothing; a null source is a source of its own. Equal rows are documents
    of their own. Rows without doc_id, or of one doc_id, have keys by their texts. Empty tables give empty results. Targets are doubles.
    """
    return _mixed(without(docs, RESULTS), docs.columns, weights, share, most, seed)


def mix_sizes(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """As ``mix_sources``, but returns only doc_id, source and the four results; texts are read once and left behind."""
    return _mixed(docs, ["doc_id", "source"], weights, share, most, seed)


def _mixed(docs: DataFrame, kept: list[str], weights: Sequence[float], share: float, most: float, seed: int) -> DataFrame:
    # of the text too, so that rows without id, or of one id, have keys of their own
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(str(seed)), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))))
    # columns of the input travel under one name, so that theirs can't clash with the working ones
    sized = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c in kept)).alias("row"), F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source_key"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"), key.alias("key"))
    return _taken(materialize(sized, "sized"), weights, share, most).select("row.*", *RESULTS)


def _taken(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    ranges = max(1, math.isqrt(sized.count()))
    place = (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * ranges / F.lit(1 << 32)).cast("long")
    sized = sized.withColumn("range", place)
    group = ["no_source", "source_key", "range"]
    totals = sized.groupBy(*group).agg(F.sum("size").alias("range_size"))
    by_source = Window.partitionBy("no_source", "source_key")
    earlier = by_source.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*group, F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("range_start"))
    sources = sized.groupBy("no_source", "source_key").agg(F.sum("size").alias("source_size"))
    budget = F.round("target").cast("long")
    targets = source_targets(sources, weights, share, most).select(
        "*", F.when(F.col("source_size") > 0, F.expr("CAST(round(target) AS BIGINT) DIV source_size")).otherwise(0).alias("rounds"))
    targets = targets.withColumn("rest", budget - F.col("rounds") * F.col("source_size"))
    before = Window.partitionBy(*group).orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("range_start") + F.coalesce(F.sum("size").over(before), F.lit(0))
    more = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - start))
    known = totals.join(targets, ["no_source", "source_key"])
    return sized.join(known, group).withColumn("taken", F.col("rounds") * F.col("size") + more)


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':0:' || md5(coalesce(text, ''))) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w,
         2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS budget
  FROM sources),
steps AS (
  SELECT *, (budget - coalesce(sum(cap) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS step
  FROM ranked WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(cap, max(step) OVER () * w) AS target FROM steps),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS rounds FROM targets),
running AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized)
SELECT r.doc_id, CAST(r.size AS BIGINT) AS size, b.source_size, b.target,
       CAST(b.rounds * r.size + greatest(0, least(r.size, CAST(round(b.target) AS BIGINT) - b.rounds * b.source_size - r.before)) AS BIGINT) AS taken
FROM running r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
"""
