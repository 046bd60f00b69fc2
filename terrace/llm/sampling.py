"""Samples whose category shares meet given targets.

1. One pass keeps mergeable bottom-k reservoirs per (draw, category): every row has a priority that depends only on its
   iri, the draw and the seed, and a reservoir holds the rows of least priority, as many as the category could be asked
   for. A task drops rows above the reservoir's bar at once and sorts only what came since. The pass also counts pools.
2. From the final counts the quotas of a draw are solved: a category gets its share of ``sample_size`` in proportion to
   its target, but not less than its minimum and not more than its pool; what exhausted categories cannot give goes to
   the others in proportion. The level at which all this adds up to ``sample_size`` lies between two of the points at
   which a category leaves its minimum or reaches its pool; fractions go to the largest remainders, in whole numbers.
3. The merged reservoirs are trimmed to the quotas by priority: rows are counted in bins of priority, bins below the
   quota's bin are taken whole, and only the rows of that one bin are ranked. No task sees a whole category.

Defined results: for each (build, iri) the row loaded last is valid; category names match without case and
surrounding white space; rows with null bucket or rank are in no pool; targets with null or negative numbers count as 0;
repeated target rows count once; two spellings of a category in one draw share one sample of the greater target and
minimum and are reported each; unknown categories are reported with an empty pool; minimums that together exceed the
sample size are kept all the same; categories without target share give their minimum only; empty tables give empty
results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.functions.text import strip_space
from terrace.runtime import cut, lookup_join

SEED = 42
BINS = 256
FLUSH_ROWS = 500_000

_KEY = ["draw_id", "build", "max_rank", "cat"]
_OUT = "draw_id bigint, build string, max_rank int, cat string, iri string, rank int, prio bigint, n bigint"


def category(name):
    return F.lower(strip_space(name))


def valid_rows(ranked: DataFrame, *columns: str) -> DataFrame:
    """The row loaded last of each (build, iri)."""
    last = ranked.groupBy("build", "iri").agg(F.max(F.struct("loaded_at", *columns)).alias("_l"))
    return last.select("build", "iri", *[F.col(f"_l.{c}").alias(c) for c in columns])


def wanted_rows(targets: DataFrame) -> DataFrame:
    """Distinct target rows with their category, ``need`` as reported, and the numbers the quotas are solved from."""
    whole = lambda c: F.greatest(F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")), F.lit(0).cast("bigint"))
    share = F.floor(whole("sample_size") * whole("target_permille") / 1000).cast("bigint")
    return targets.select(
        "draw_id", "build", "max_rank", "bucket", category(F.col("bucket")).alias("cat"), whole("sample_size").alias("size"), whole("target_permille").alias("weight"),
        whole("min_rows").alias("least"), F.greatest(whole("min_rows"), share).alias("need"),
    ).distinct()


class Reservoirs:
    """Bottom-k rows of a task's categories. ``need`` may differ by category."""

    def __init__(self):
        self.codes: dict[tuple, int] = {}
        self.need: list[int] = []
        self.seen: list[int] = []
        self.bar = np.zeros(0, dtype=np.int64)
        self.parts: list[pd.DataFrame] = []
        self.rows = self.sorted = 0

    def add(self, frame: pd.DataFrame) -> None:
        groups = frame.groupby(_KEY, sort=False, dropna=False)
        local, first = groups.ngroup().to_numpy(), groups.head(1)
        codes = np.empty(len(first), dtype=np.int64)
        for k, row in enumerate(first[[*_KEY, "need"]].itertuples(index=False, name=None)):
            code = self.codes.setdefault(row[:-1], len(self.codes))
            if code == len(self.need):
                self.need.append(int(row[-1]))
                self.seen.append(0)
            codes[k] = code
        if len(self.bar) < len(self.need):
            self.bar = np.append(self.bar, np.full(len(self.need) - len(self.bar), np.iinfo(np.int64).max))
        code = codes[local]
        for c, n in zip(*np.unique(code, return_counts=True)):
            self.seen[c] += int(n)
        near = frame["prio"].to_numpy() <= self.bar[code]
        part = frame.loc[near, ["iri", "rank", "prio"]].assign(code=code[near])
        self.parts.append(part)
        self.rows += len(part)
        if self.rows > 2 * self.sorted + 10_000:
            self.trim()

    def trim(self) -> None:
        if not self.parts:
            return
        all_ = pd.concat(self.parts)
        all_ = all_.iloc[np.lexsort((all_["prio"].to_numpy(), all_["code"].to_numpy()))]
        code = all_["code"].to_numpy()
        place = np.arange(len(code)) - np.searchsorted(code, code)
        need = np.array(self.need, dtype=np.int64)
        last = place == need[code] - 1
        self.bar[code[last]] = all_["prio"].to_numpy()[last]
        all_ = all_[(place < need[code]) | (all_["prio"].to_numpy() == self.bar[code])]  # ties stay until the last trim
        self.parts, self.rows, self.sorted = [all_], len(all_), len(all_)

    def flush(self) -> Iterator[pd.DataFrame]:
        self.trim()
        names = pd.DataFrame(list(self.codes), columns=_KEY)
        for rows in self.parts:
            if len(rows):
                named = names.iloc[rows["code"].to_numpy()].reset_index(drop=True)
                yield named.assign(iri=rows["iri"].to_numpy(), rank=rows["rank"].to_numpy(), prio=rows["prio"].to_numpy(), n=0)
        if len(names):
            yield names.assign(iri=None, rank=None, prio=None, n=self.seen)
        self.__init__()


def _reservoirs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reservoir rows, and for each category one row without iri that counts its pool in this task."""
    kept = Reservoirs()
    for frame in frames:
        if len(frame):
            kept.add(frame)
        if kept.rows > FLUSH_ROWS and kept.sorted > FLUSH_ROWS // 2 or len(kept.codes) > FLUSH_ROWS:
            yield from kept.flush()
    yield from kept.flush()


def solve(per_cat: DataFrame) -> DataFrame:
    """``per_cat`` (the key, size, weight, least, pool) with ``quota``.

    Minimum and pool bound a category's share ``weight * level``. The level at which the shares add up to ``size`` is
    found from running sums over the points of change; quotas are then whole numbers over one denominator.
    """
    key = ["draw_id", "build", "max_rank"]
    low = F.least("least", "pool")
    c = per_cat.withColumns({"low": low, "size": F.max("size").over(W.partitionBy(*key)), "lows": F.sum(low).over(W.partitionBy(*key))})
    at = lambda x: F.when(F.col("weight") > 0, x / F.col("weight"))
    c = c.withColumns({"opens": at(F.col("low")), "fills": at(F.col("pool"))})
    turn = lambda t, w, k: F.struct(t.alias("t"), w.alias("w"), k.alias("k"))
    turns = c.filter("weight > 0").select(*key, "size", "lows", F.explode(F.array(turn(F.col("opens"), F.col("weight"), -F.col("low")), turn(F.col("fills"), -F.col("weight"), F.col("pool")))).alias("e"))
    turns = turns.groupBy(*key, "size", "lows", "e.t").agg(F.sum("e.w").alias("w"), F.sum("e.k").alias("k"))
    upto = W.partitionBy(*key).orderBy("t").rowsBetween(W.unboundedPreceding, 0)
    level = turns.select(*key, "size", "t", F.sum("w").over(upto).alias("slope"), (F.col("lows") + F.sum("k").over(upto)).alias("fixed"))
    level = level.filter(F.col("fixed") + F.col("slope") * F.col("t") <= F.col("size")).groupBy(*key).agg(F.max(F.struct("t", "slope", "fixed")).alias("at"))
    c = _same(c, level, key)
    rest, slope, t = F.col("size") - F.col("at.fixed"), F.col("at.slope"), F.col("at.t")
    open_ = F.col("at").isNotNull() & (F.col("weight") > 0) & (F.col("opens") <= t) & (F.col("fills") > t)
    full = F.col("at").isNotNull() & (F.col("weight") > 0) & (F.col("fills") <= t)
    c = c.withColumns({"part": F.when(open_, F.call_function("div", rest * F.col("weight"), slope)), "left": F.when(open_, (rest * F.col("weight")) % slope)})
    over = W.partitionBy(*key)
    spare = rest - F.sum("part").over(over)
    place = F.row_number().over(over.orderBy(F.col("left").desc_nulls_last(), "cat"))
    quota = F.when(open_, F.col("part") + F.when(place <= spare, 1).otherwise(0)).when(full, F.col("pool")).otherwise(F.col("low"))
    return c.withColumn("quota", quota.cast("bigint")).select(*per_cat.columns, "quota")


def _same(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Left join on a key that may hold nulls."""
    named = right.withColumnsRenamed({c: f"_r_{c}" for c in key})
    on = F.lit(True)
    for c in key:
        on = on & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(named, on, "left").drop(*[f"_r_{c}" for c in key])


@dataclass
class Draw:
    sample: DataFrame
    report: DataFrame


def draw(ranked: DataFrame, targets: DataFrame, seed: int = SEED) -> Draw:
    """``sample``: draw_id, cat, iri, rank. ``report``: one row per target: draw_id, bucket, need, pool, short (the pool
    is below the need), quota, target_share and share (of the draw's rows), reason (null: met)."""
    wanted = cut(wanted_rows(targets))
    per_cat = wanted.groupBy(*_KEY).agg(*[F.max(c).alias(c) for c in ("size", "weight", "least")])
    asked = per_cat.filter("cat is not null and draw_id is not null and build is not null").select(*_KEY, F.greatest("size", "least").alias("need"))
    rows = valid_rows(ranked, "rank", "bucket").select("build", "iri", "rank", category(F.col("bucket")).alias("cat")).filter("rank is not null and cat is not null")
    pool = lookup_join(rows, asked, ["build", "cat"]).filter("rank <= max_rank")
    pool = pool.select(*_KEY, "iri", "rank", F.shiftrightunsigned(F.xxhash64("iri", "draw_id", F.lit(seed)), 1).alias("prio"), "need")
    kept = cut(pool.mapInPandas(_reservoirs, _OUT))
    counts = kept.filter("iri is null").groupBy(*_KEY).agg(F.sum("n").alias("pool"))
    solved = cut(solve(_same(per_cat, counts, _KEY).withColumn("pool", F.coalesce("pool", F.lit(0).cast("bigint")))))

    # bins of priority so wide that a category's quota fills about BINS of them
    width = F.greatest(F.lit(2.0**63) * F.col("quota") / F.col("pool") / BINS, F.lit(1.0))
    quotas = solved.filter("quota > 0").select(*_KEY, "quota", width.alias("width"))
    placed = lookup_join(kept.filter("iri is not null").drop("n"), quotas, _KEY).withColumn("bin", F.least(F.floor(F.col("prio") / F.col("width")), F.lit(4 * BINS)))
    upto = W.partitionBy(*_KEY).orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    bins = placed.groupBy(*_KEY, "quota", "bin").agg(F.count("*").alias("here")).withColumn("upto", F.sum("here").over(upto))
    bars = bins.filter("upto >= quota").groupBy(*_KEY).agg(F.min(F.struct("bin", (F.col("quota") - F.col("upto") + F.col("here")).alias("of_bin"))).alias("bar"))
    edge = lookup_join(placed, bars.select(*_KEY, "bar.*").withColumnRenamed("bin", "last"), _KEY)
    whole = edge.filter("bin < last")
    ranked_bin = edge.filter("bin = last").withColumn("_r", F.row_number().over(W.partitionBy(*_KEY).orderBy("prio", "iri"))).filter("_r <= of_bin")
    sample = whole.select("draw_id", "cat", "iri", "rank").union(ranked_bin.select("draw_id", "cat", "iri", "rank"))
    return Draw(sample, _report(wanted, solved))


def _report(wanted: DataFrame, solved: DataFrame) -> DataFrame:
    draw_ = W.partitionBy("draw_id", "build", "max_rank")
    share = lambda c: F.round(F.when(F.sum(c).over(draw_) > 0, F.col(c) / F.sum(c).over(draw_)), 6)
    s = solved.select(*_KEY, "pool", "quota", "weight", "least", "size", share("weight").alias("target_share"), share("quota").alias("share"), F.sum("quota").over(draw_).alias("total"))
    full = (F.col("quota") == F.col("pool")) & (F.col("weight") > 0)
    reason = (
        F.when(F.col("pool") < F.col("need"), "pool_below_need").when(F.col("total") > F.col("size"), "minimums_exceed_sample")
        .when(full & (F.col("quota") * F.col("weights") < F.col("weight") * F.col("size")), "exhausted").when(F.col("total") < F.col("size"), "draw_exhausted")
    )
    s = s.withColumn("weights", F.sum("weight").over(draw_)).drop("weight", "least", "size")
    out = _same(wanted, s, _KEY)
    return out.select("draw_id", "bucket", "need", "pool", (F.col("pool") < F.col("need")).alias("short"), "quota", "target_share", "share", reason.alias("reason"))
