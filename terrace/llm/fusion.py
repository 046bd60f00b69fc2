"""One ranking from several differently-scaled scores.

Each score is standardised robustly within its build (median and median absolute deviation, heavy-tailed counts on a
log scale), squashed by the logistic function to (0, 1), and the bounded values are combined by a weighted geometric
mean. All is done with the logarithms of the bounded values, which neither round to 1 nor to 0, so no clamp is needed
and the mean is a weighted sum.

Medians, deviations and leading values are exact order statistics. A mergeable sketch brackets each within a small
share of the ranks; one pass then counts what lies below the bracket and the values inside, where the ranks are read
off. A bracket that should miss is taken again without bounds. No build is ever sorted or gathered: what is shuffled
are sketches and counts. Places come from ranges of the combined value over all builds, bounded in size.

Defined results: for each (build, iri) the row loaded last is valid; scores are compared as doubles; a null or NaN
score is lower than all others, its bounded value is half of the least one of the build (one half, if there is none); a
deviation of 0 counts as 1; equal combined values share a place; empty tables give empty results; rows with null build
form a build of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.llm.sampling import valid_rows
from terrace.runtime import cut, cut_counting, lookup_join

MAD_SCALE = 1.4826
ACCURACY, SLACK = 5_000, 0.001
RANGE_ROWS = 1_000_000
#: A row leads a score if fewer than one in so many rows of its build are strictly higher.
LEAD_SHARE = 50
LOWEST = float("-inf")


@dataclass(frozen=True)
class Score:
    name: str
    weight: float
    log: bool = False

    def scaled(self, value: Column) -> Column:
        return F.signum(value) * F.log1p(F.abs(value)) if self.log else value


SCORES = (Score("views", 0.4, log=True), Score("languages", 0.3, log=True), Score("score", 0.3))


@dataclass(frozen=True)
class Ask:
    """The values of ``value`` at the ascending positions (from 1) that ``at`` gives for the number of its values;
    ``share`` says about which part of them lies below."""

    name: str
    value: Column
    share: float
    at: Callable[[Column], tuple[Column, Column]]


def middle(count: Column) -> tuple[Column, Column]:
    return F.floor((count + 1) / 2), F.floor((count + 2) / 2)


def order_statistics(rows: DataFrame, key: str, asks: list[Ask], *more: Column) -> DataFrame:
    """``key``, for each ask ``{name}_low`` and ``{name}_high``, and the aggregates ``more``."""
    values = rows.select(key, *[a.value.alias(f"v{i}") for i, a in enumerate(asks)])
    brackets = [[max(a.share - SLACK, 0.0), min(a.share + SLACK, 1.0)] for a in asks]
    sketch = rows.groupBy(key).agg(
        *[F.count(a.value).alias(f"c{i}") for i, a in enumerate(asks)], *[F.percentile_approx(a.value, b, ACCURACY).alias(f"b{i}") for i, (a, b) in enumerate(zip(asks, brackets))], *more
    )
    sketch = cut(sketch)
    positions = F.array(*[F.struct(*[x.cast("bigint").alias(n) for x, n in zip(a.at(F.col(f"c{i}")), ("first", "last"))]) for i, a in enumerate(asks)])
    bounds = sketch.select(key, *[F.col(f"b{i}")[j].alias(f"{n}{i}") for i in range(len(asks)) for j, n in enumerate(("lo", "hi"))])
    places = sketch.select(F.col(key).alias("_key"), positions.alias("at"))

    def within(limits: DataFrame) -> DataFrame:
        pieces = [F.struct(F.lit(i).alias("ask"), F.when(F.col(f"v{i}") >= F.col(f"lo{i}"), F.col(f"v{i}")).alias("x"), (F.col(f"v{i}") <= F.col(f"hi{i}")).alias("ok")) for i in range(len(asks))]
        seen = lookup_join(values, limits, [key]).select(key, F.explode(F.array(*pieces)).alias("p")).filter("p.ok")
        counted = seen.groupBy(key, "p.ask", "p.x").agg(F.count("*").alias("c"))
        upto = F.sum("c").over(W.partitionBy(key, "ask").orderBy(F.col("x").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0))
        met = counted.withColumn("upto", upto).join(places, F.col(key) == F.col("_key")).withColumn("at", F.col("at")[F.col("ask")])
        near = met.filter("x is not null and upto >= at.first and upto - c < at.last")
        read = near.groupBy(key, "ask", "at").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.min(F.col("upto") - F.col("c")).alias("below"), F.max("upto").alias("upto"))
        return read.filter("below < at.first and upto >= at.last").select(key, "ask", "low", "high")

    found = cut(within(bounds))
    due = places.select(F.col("_key").alias(key), F.posexplode("at").alias("ask", "a")).filter("a.first > 0").join(found, [key, "ask"], "left_anti")
    due, seen = cut_counting(due, n=F.count("*"))
    if seen["n"]:
        open_ = lambda i, bound: F.max(F.when(F.col("ask") == i, F.lit(bound)))
        found = found.union(within(due.groupBy(key).agg(*[open_(i, b).alias(f"{n}{i}") for i in range(len(asks)) for n, b in (("lo", LOWEST), ("hi", math.inf))])))
    wide = found.groupBy(key).agg(*[F.max(F.when(F.col("ask") == i, F.col(end))).alias(f"{a.name}_{end}") for i, a in enumerate(asks) for end in ("low", "high")])
    return sketch.select(key, *[c for c in sketch.columns if c != key and c not in {f"{x}{i}" for x in "bc" for i in range(len(asks))}]).join(wide, key, "left")


def log_logistic(z: Column) -> Column:
    """ln(1 / (1 + exp(-z))), without overflow on either side and growing with z throughout."""
    return F.when(z > 0, -F.log1p(F.exp(-z))).otherwise(z - F.log1p(F.exp(z)))


def fuse(ranked: DataFrame, scores: tuple[Score, ...] = SCORES) -> DataFrame:
    """build, iri, the scores, ``log_fused`` (logarithm of the combined value), ``fused`` and ``leads`` (in each score
    fewer than 1/50 of the build are strictly higher).

    Rows that lead are found by the ranking: all steps from score to combined value keep the order, so a row that
    leads every score has bounded values and a combined value of at least those of the leading values; on such rows the
    scores themselves decide, as different scores may have equal bounded values.
    """
    rows = valid_rows(ranked, *[s.name for s in scores])
    clean = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double") + F.lit(0.0))
    rows = cut(rows.select(F.coalesce(F.concat(F.lit("b"), F.col("build").cast("string")), F.lit("n")).alias("_b"), "build", "iri", *[clean(s.name).alias(s.name) for s in scores]))
    filled = {s.name: F.coalesce(F.col(s.name), F.lit(LOWEST)) for s in scores}

    def leading(count: Column) -> tuple[Column, Column]:
        at = count - F.ceil(count / LEAD_SHARE) + 1
        return at, at

    asks = [Ask(f"med_{s.name}", F.col(s.name), 0.5, middle) for s in scores] + [Ask(f"lead_{s.name}", filled[s.name], 1 - 1 / LEAD_SHARE, leading) for s in scores]
    first = order_statistics(rows, "_b", asks, *[F.min(s.name).alias(f"min_{s.name}") for s in scores])
    median = lambda s: (s.scaled(F.col(f"med_{s.name}_low")) + s.scaled(F.col(f"med_{s.name}_high"))) / 2
    first = cut(first.select("_b", *[median(s).alias(f"med_{s.name}") for s in scores], *[F.col(f"lead_{s.name}_low").alias(f"lead_{s.name}") for s in scores], *[f"min_{s.name}" for s in scores]))
    away = lookup_join(rows, first, ["_b"]).select("_b", *[F.abs(s.scaled(F.col(s.name)) - F.col(f"med_{s.name}")).alias(s.name) for s in scores])
    second = order_statistics(away, "_b", [Ask(s.name, F.col(s.name), 0.5, middle) for s in scores])
    mad = lambda s: (F.col(f"{s.name}_low") + F.col(f"{s.name}_high")) / 2 * MAD_SCALE
    spread = lambda s: F.when(mad(s) > 0, mad(s)).otherwise(1.0)
    stats = cut(first.join(second.select("_b", *[spread(s).alias(f"spread_{s.name}") for s in scores]), "_b"))

    def bounded(s: Score, value: Column) -> Column:
        one = lambda v: log_logistic((s.scaled(v) - F.col(f"med_{s.name}")) / F.col(f"spread_{s.name}"))
        none = F.coalesce(one(F.col(f"min_{s.name}")), F.lit(0.0)) - math.log(2)
        return F.when(value > LOWEST, one(value)).otherwise(none)

    total = sum(s.weight for s in scores)
    mean = lambda parts: sum((p * (s.weight / total) for s, p in zip(scores, parts)), F.lit(0.0))
    stats = cut(stats.select("*", *[bounded(s, F.col(f"lead_{s.name}")).alias(f"at_{s.name}") for s in scores]).withColumn("at", mean([F.col(f"at_{s.name}") for s in scores])))
    joined = lookup_join(rows, stats, ["_b"]).select("*", *[bounded(s, F.col(s.name)).alias(f"is_{s.name}") for s in scores]).withColumn("log_fused", mean([F.col(f"is_{s.name}") for s in scores]))
    near, leads = F.col("log_fused") >= F.col("at"), F.lit(True)
    for s in scores:
        near = near & (F.col(f"is_{s.name}") >= F.col(f"at_{s.name}"))
        leads = leads & (filled[s.name] >= F.col(f"lead_{s.name}"))
    return joined.select("build", "iri", *[s.name for s in scores], "log_fused", F.exp("log_fused").alias("fused"), (near & leads).alias("leads"))


def with_places(fused: DataFrame) -> DataFrame:
    """Adds ``place``: 1 plus the number of rows of the build with a strictly higher combined value."""
    fused, seen = cut_counting(fused.withColumn("_b", F.coalesce(F.concat(F.lit("b"), F.col("build").cast("string")), F.lit("n"))), n=F.count("*"))
    counted = fused.groupBy("_b", "log_fused").agg(F.count("*").alias("n"))
    ranges = counted.repartitionByRange(max(1, -(-seen["n"] // RANGE_ROWS)), "_b", F.desc("log_fused"))
    ranges = cut(ranges.select("*", F.spark_partition_id().alias("_range")))
    over = ranges.groupBy("_b", "_range").agg(F.sum("n").alias("_n"))
    before = over.select("_b", "_range", F.coalesce(F.sum("_n").over(W.partitionBy("_b").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    here = F.coalesce(F.sum("n").over(W.partitionBy("_b", "_range").orderBy(F.desc("log_fused")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    places = lookup_join(ranges.withColumn("_here", here), before, ["_b", "_range"]).select("_b", "log_fused", (F.col("_before") + F.col("_here") + 1).alias("place"))
    return fused.join(places, ["_b", "log_fused"]).drop("_b")
