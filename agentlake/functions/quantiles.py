"""Exact quantiles over columns of any size.

``percentile`` keeps every distinct value of its group in one task. Here a first
scan makes a mergeable sketch of each column, of fixed size. It tells between
which two values each wanted rank lies; a second scan counts the values below,
and sorts only those between. Where too many lie between, the sketch is made
again of these alone. Sketches may be wrong, so the counts of the last scan
decide: a rank that is not where it was looked for is looked for in a wider
range.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

#: Size of a sketch. Fewer values are looked through as they are.
SKETCH = 4096
#: By how much of its values' number a rank of a sketch may be off; it is seldom a third of this.
MARGIN = 0.003
#: Values between two bounds that one task sorts, counted by distinct value.
SORTED_ROWS = 1 << 21

RESULT = "metric STRING, q DOUBLE, value DOUBLE"


@dataclass(frozen=True)
class Target:
    """A quantile: one or two neighbouring ranks among ``total`` values, looked for from ``low`` to ``high``, between which
    there are about ``inside`` values."""

    metric: str
    q: float
    total: int
    low: float
    high: float
    inside: int

    @property
    def spot(self) -> float:
        return (self.total - 1) * self.q

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.spot), math.ceil(self.spot)

    @property
    def value(self) -> Column:
        return _value(self.metric)


def _value(metric: str) -> Column:
    return F.col(f"`{metric}`").cast("double")


def _sketch(value: Column) -> Column:
    return F.kll_sketch_agg_double(F.when(F.isnan(value), F.lit(math.inf)).otherwise(value), F.lit(SKETCH))


def _at(sketch: Column, *ranks: float) -> Column:
    """Values of a sketch at ranks between 0 and 1."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*(F.lit(min(1.0, max(0.0, r))) for r in ranks)))


def _sketched(df: DataFrame, wanted: dict[str, list[float]], margin: float) -> list[Target]:
    """Bounds of all quantiles, by one scan. Of few values all are looked through. NaN is the largest value."""
    facts = [F.struct(F.count(_value(m)).alias("n"), F.min(_value(m)).alias("low"), F.max(_value(m)).alias("high"), _sketch(_value(m)).alias("s")) for m in wanted]
    row = df.agg(*(f.alias(f"m{k}") for k, f in enumerate(facts)))
    bounds = [F.struct(f"m{k}.n", f"m{k}.low", f"m{k}.high", *(
        F.when((F.col(f"m{k}.n") > SKETCH) & F.lit(margin < 1), _at(F.col(f"m{k}.s"), q - margin, q + margin)).alias(f"q{i}")
        for i, q in enumerate(qs))).alias(f"m{k}") for k, qs in enumerate(wanted.values())]
    targets = []
    for fact, (metric, qs) in zip(row.select(*bounds).first(), wanted.items()):
        for i, q in enumerate(qs):
            near = fact[f"q{i}"]
            if fact.n:
                targets.append(Target(metric, q, fact.n, *((*near, int(2 * margin * fact.n)) if near else (fact.low, fact.high, fact.n))))
    return targets


def _narrowed(df: DataFrame, targets: list[Target], margin: float) -> list[Target]:
    """The same quantiles between closer bounds, by counts and sketches of the values between the present ones, in one scan.
    Those that turn out not to lie there are left out."""
    parts = [F.struct(F.count_if(t.value < F.lit(t.low)).alias("below"), F.count_if(t.value.between(F.lit(t.low), F.lit(t.high))).alias("inside"),
                      _sketch(F.when(t.value.between(F.lit(t.low), F.lit(t.high)), t.value)).alias("s")).alias(f"t{k}") for k, t in enumerate(targets)]
    steps = math.ceil(1 / margin)
    values = [F.struct(f"t{k}.below", f"t{k}.inside", F.when(F.col(f"t{k}.inside") > 0, _at(F.col(f"t{k}.s"), *(i / steps for i in range(steps + 1)))).alias("values")).alias(f"t{k}")
              for k in range(len(targets))]
    narrowed = []
    for t, f in zip(targets, df.agg(*parts).select(*values).first()):
        if f.below <= t.ranks[0] and t.ranks[1] < f.below + f.inside:
            first, last = ((r - f.below) / max(1, f.inside - 1) for r in t.ranks)
            low, high = max(0, math.floor((first - margin) * steps)), min(steps, math.ceil((last + margin) * steps))
            narrowed.append(replace(t, low=f["values"][low], high=f["values"][high], inside=(high - low) * f.inside // steps))
    return narrowed


def _sorted_values(df: DataFrame, targets: list[Target]) -> list[Row]:
    """For each target (``t``, by its number) the values of its ranks, null if they don't lie between its bounds, in one scan."""
    # what lies below is one cell, counted where it is read
    entries = [F.when(t.value <= F.lit(t.high), F.struct(F.lit(k).alias("t"), F.when(t.value >= F.lit(t.low), t.value).alias("v"))) for k, t in enumerate(targets)]
    rows = df.select(F.explode(F.array(*entries)).alias("x")).where("x IS NOT NULL").select("x.t", "x.v")
    cells = rows.groupBy("t", "v").agg(F.count("*").alias("n"))
    until = F.sum("n").over(Window.partitionBy("t").orderBy(F.asc_nulls_first("v")))
    bounds = F.create_map(*(x for k, t in enumerate(targets) for x in (F.lit(k), F.array(*map(F.lit, t.ranks)))))[F.col("t")]
    placed = cells.withColumn("until", until).withColumn("since", F.col("until") - F.col("n")).withColumn("ranks", bounds)

    def at(k: int) -> Column:
        held = F.col("v").isNotNull() & (F.col("since") <= F.col("ranks")[k]) & (F.col("ranks")[k] < F.col("until"))
        return F.max(F.when(held, F.struct("v")))

    return placed.groupBy("t").agg(at(0).alias("first"), at(1).alias("last")).collect()  # a row a target


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> DataFrame:
    """Interpolated quantiles as rows ``(metric, q, value)``; nulls are skipped.

    ``wanted`` maps numeric columns to fractions between 0 and 1. Scans ``df`` twice at once, and once more for every
    factor of about a hundred beyond some hundred million values; the driver gets a few numbers of each quantile.
    """
    open_, found, margin = {m: list(dict.fromkeys(map(float, qs))) for m, qs in wanted.items()}, {}, MARGIN
    while any(open_.values()):
        targets = _sketched(df, open_, margin)
        asked = {(t.metric, t.q) for t in targets}  # columns without values have none
        before = math.inf
        # where bounds come no closer, equal values stand between them, which are sorted as one
        while targets and margin < 1 and before / 2 > (most := max(t.inside for t in targets)) > SORTED_ROWS:
            before, targets = most, _narrowed(df, targets, margin)
        for row in _sorted_values(df, targets) if targets else ():
            if row.first is not None and row.last is not None:
                t, low, high = targets[row.t], row.first.v, row.last.v
                found[t.metric, t.q] = low if low == high else low + (high - low) * (t.spot - t.ranks[0])
        # what a sketch has missed is looked for again, between wider bounds
        open_ = {m: [q for q in qs if (m, q) in asked and (m, q) not in found] for m, qs in open_.items()}
        margin = min(1.0, 8 * margin)
    rows = [(m, float(q), found[m, float(q)]) for m, qs in wanted.items() for q in dict.fromkeys(map(float, qs)) if (m, q) in found]
    return df.sparkSession.createDataFrame(rows, RESULT)
