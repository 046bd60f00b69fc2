"""Scores within buckets, the interleave of buckets by shares, tiers, and what each bucket is asked for."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.functions.text import normalize_title

MAX_BUCKETS = 10_000


@dataclass(frozen=True)
class Bucket:
    name: str
    share: float


def normalised(buckets: list[Bucket]) -> list[Bucket]:
    total = sum(b.share for b in buckets)
    if total <= 0 or len({b.name for b in buckets}) < len(buckets):
        raise ValueError("bucket names must be unique and shares sum to more than 0")
    return [Bucket(b.name, b.share / total) for b in buckets]


def bucket_scores(pool: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``pool`` with ``score``: the weighted sum of log1p z-scores within the bucket.

    Means and sample deviations come from one partial-aggregated pass per bucket; a deviation of null or 0 counts
    as 1. The statistics are one row per bucket, so a hot bucket is never gathered in one task.
    """
    logs = {c: F.log1p(F.col(c).cast("double")) for c in weights}
    stats = pool.groupBy("bucket").agg(*[F.avg(x).alias(f"_m_{c}") for c, x in logs.items()], *[F.stddev_samp(x).alias(f"_s_{c}") for c, x in logs.items()])
    stats = stats.withColumnRenamed("bucket", "_bucket")
    joined = pool.join(stats, F.col("bucket").eqNullSafe(F.col("_bucket")))
    z = lambda c: (logs[c] - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(1.0)
    score = sum((F.lit(w) * z(c) for c, w in weights.items()), F.lit(0.0))
    return joined.withColumn("score", score).select(*pool.columns, "score")


def above_floor(scored: DataFrame, floors: dict[str, int]) -> DataFrame:
    keep = F.lit(True)
    for c, least in floors.items():
        keep = keep & (F.col(c) >= least)
    return scored.filter(keep)


@dataclass
class Sequence:
    picks: pd.DataFrame
    exhausted: list[dict]


def interleave(pools: dict[str, int], buckets: list[Bucket], n: int) -> Sequence:
    """The order in which buckets are picked, from pool sizes alone: at step k the bucket with the greatest
    share * k - taken among those not used up, the first listed at a tie. A prefix of the sequence for n is the
    sequence for any smaller n.
    """
    shares = np.array([b.share for b in normalised(buckets)])
    left = np.array([pools.get(b.name, 0) for b in buckets], dtype=np.int64)
    taken = np.zeros(len(buckets), dtype=np.int64)
    exhausted = [{"bucket": b.name, "step": 0, "taken": 0} for b, size in zip(buckets, left) if size == 0]
    names, places = [], []
    open_ = left > 0
    for k in range(1, n + 1):
        if not open_.any():
            break
        lack = np.where(open_, shares * k - taken, -np.inf)
        i = int(lack.argmax())
        taken[i] += 1
        names.append(buckets[i].name)
        places.append(int(taken[i]))
        if taken[i] == left[i]:
            open_[i] = False
            exhausted.append({"bucket": buckets[i].name, "step": k, "taken": int(taken[i])})
    return Sequence(pd.DataFrame({"rank": range(1, len(names) + 1), "bucket": pd.Series(names, dtype="object"), "pos": pd.Series(places, dtype="int64")}), exhausted)


def pool_sizes(pool: DataFrame, buckets: list[Bucket]) -> dict[str, int]:
    """Rows by bucket. Buckets are configuration; more than ``MAX_BUCKETS`` of them are refused."""
    names = [b.name for b in buckets]
    if len(names) > MAX_BUCKETS:
        raise ValueError(f"more than {MAX_BUCKETS} buckets")
    return {r["bucket"]: r["n"] for r in pool.filter(F.col("bucket").isin(names)).groupBy("bucket").agg(F.count("*").alias("n")).collect()}


def rank_entities(pool: DataFrame, buckets: list[Bucket], tiers: list[int], allow_short: bool = True) -> DataFrame:
    """``rank``, ``iri``, ``bucket``, ``score``, ``tier_min``: the entities in interleaved order.

    Only pool sizes reach the driver. Within a bucket entities go by score, then iri; a bucket gives at most the
    largest tier, so its window stops there.
    """
    if tiers != sorted(set(tiers)):
        raise ValueError("tiers must ascend")
    spark = pool.sparkSession
    names = [b.name for b in buckets]
    seq = interleave(pool_sizes(pool, buckets), buckets, tiers[-1])
    if len(seq.picks) < tiers[-1] and not allow_short:
        raise ValueError(f"only {len(seq.picks)} of {tiers[-1]} entities")
    order = spark.createDataFrame(seq.picks, "rank int, bucket string, pos bigint")
    best = W.partitionBy("bucket").orderBy(F.desc("score"), "iri")
    placed = pool.filter(F.col("bucket").isin(names)).withColumn("pos", F.row_number().over(best).cast("bigint")).filter(F.col("pos") <= tiers[-1])
    tier = F.when(F.col("rank") <= tiers[0], tiers[0])
    for t in tiers[1:]:
        tier = tier.when(F.col("rank") <= t, t)
    return placed.join(order, ["bucket", "pos"]).withColumn("tier_min", tier.cast("int")).drop("pos")


def tier_name(n: int) -> str:
    return f"t{n // 1000}" if n % 1000 == 0 else f"t{n}"


def demand(scored: DataFrame, buckets: list[Bucket], floors: dict[str, int], n: int) -> DataFrame:
    """Per bucket the pool, what is above the floors, the demand (half-even rounding) and the shortfall."""
    spark = scored.sparkSession
    above = F.lit(True)
    for c, least in floors.items():
        above = above & (F.col(c) >= least)
    wanted = spark.createDataFrame([(i, b.name, float(b.share)) for i, b in enumerate(normalised(buckets))], "ord int, bucket string, share double")
    counts = scored.groupBy("bucket").agg(F.count("*").alias("pool"), F.count_if(above).alias("above_floor"))
    rows = F.broadcast(wanted).join(counts, "bucket", "left")
    have = F.coalesce("above_floor", F.lit(0).cast("bigint"))
    need = F.bround(F.col("share") * n, 0).cast("bigint")
    return rows.select("bucket", F.coalesce("pool", F.lit(0).cast("bigint")).alias("pool"), have.alias("above_floor"), need.alias("demand"), F.greatest(need - have, F.lit(0)).alias("shortfall"))


def needed_titles(english: DataFrame, sisters: DataFrame) -> DataFrame:
    """``lang``, ``title`` of each entity's English page and of its pages in sister editions (joined on q)."""
    return english.select(F.lit("en").alias("lang"), "title").union(english.select("q").join(sisters, "q").select("lang", "title")).distinct()


def views_per_entity(monthly: DataFrame, english: DataFrame, sisters: DataFrame) -> DataFrame:
    """``iri``, ``views``: views of the English title plus those of the sister editions, over all months.

    Titles are joined in their normalised form, as logs hold them raw or percent-encoded. Months are semi-joined to the
    titles needed before they are summed.
    """
    monthly, english, sisters = (df.withColumn("title", normalize_title(F.col("title"))) for df in (monthly, english, sisters))
    sisters = sisters.distinct()
    needed = needed_titles(english, sisters)
    total = monthly.join(needed, ["lang", "title"], "left_semi").groupBy("lang", "title").agg(F.sum("views").alias("views"))
    own = english.select("iri", F.lit("en").alias("lang"), "title")
    other = english.select("iri", "q").join(sisters, "q").select("iri", "lang", "title")
    return own.union(other).join(total, ["lang", "title"]).groupBy("iri").agg(F.sum("views").alias("views"))
