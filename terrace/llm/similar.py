"""Most similar vectors: a block matrix join over int8 codes with proven error bounds.

A vector is scaled to unit length and rounded to 64 signed bytes. For two codes the product of their dequantised
vectors differs from the true cosine by at most |a^| |db| + |da|, where da, db are the rounding residuals, whose
lengths are kept. A tile multiplies a block of codes with another (the byte products are exact in float32, so the
matrix library does them), drops all pairs whose upper bound cannot matter and recomputes the survivors in float.

``nearest``: stated queries, or all rows, against all rows. Blocks of queries meet blocks of rows; each tile keeps per
query a heap of the k best lower bounds and the rows whose upper bound reaches the least of them; what survives the
tiles is compared once more across them, recomputed and ranked. Work grows with queries times rows.

``similar_pairs``: all pairs from a least cosine on. Comparing all blocks with all would grow with the square of the
data, so the tiles run within the cells of several random cross-polytope partitions, whose number follows from the
collision rate of a pair exactly at the threshold (simulated for the cells in use) so that the chance to miss it is at
most ``MISS``. Cells of more than ``BLOCK`` rows are cut into blocks that meet pairwise. Copies of one vector are
compared once, through a representative.

Defined results: vectors that are null, of another length, all zero, or hold NaN, infinities or nulls are left out;
repeated rows of an entity with the same vector count once; among equal cosines the smaller id comes first; a pair has
the smaller id first; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.runtime import cut, cut_counting, lookup_join

DIMS = 64
BLOCK = 4096
CELL_ROWS = 1024
TASK_ROWS = 75_000
MISS = 2e-4
SEED = 20_260
EPS = 1e-6


def usable(vector: Column, dims: int = DIMS) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dims) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scale, length of the dequantised vector and length of the residual of unit vectors."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    return codes, scale, np.sqrt((back * back).sum(1)), np.sqrt(((x - back) ** 2).sum(1))


@dataclass
class Coded:
    ids: np.ndarray
    codes: np.ndarray
    scale: np.ndarray
    length: np.ndarray
    residual: np.ndarray

    def __getitem__(self, s) -> Coded:
        return Coded(self.ids[s], self.codes[s], self.scale[s], self.length[s], self.residual[s])


def product(a: Coded, b: Coded) -> tuple[np.ndarray, np.ndarray]:
    """Approximate cosines of a tile and their error bounds, as float32."""
    dots = a.codes.astype(np.float32) @ b.codes.astype(np.float32).T
    dots *= (a.scale.astype(np.float32))[:, None]
    dots *= (b.scale.astype(np.float32))[None, :]
    bound = np.outer(a.length, b.residual).astype(np.float32)
    bound += (a.residual + EPS).astype(np.float32)[:, None]
    return dots, bound


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()) if len(column) else np.zeros((0, DIMS))


def vectors(entities: DataFrame, key: str, vector: str) -> DataFrame:
    return entities.filter(usable(F.col(vector)) & F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(vector).alias("v"))


# ---------------------------------------------------------------- stated queries against all rows


def _encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        if len(frame):
            codes, scale, length, residual = quantise(unit(_matrix(frame["v"])))
            yield pd.DataFrame({"id": frame["id"], "code": [c.tobytes() for c in codes], "scale": scale.astype("float32"), "len": length.astype("float32"), "res": residual.astype("float32")})


def _coded_rows(f: pd.DataFrame) -> Coded:
    codes = np.frombuffer(b"".join(f["code"]), dtype=np.int8).reshape(len(f), -1)
    return Coded(f["id"].to_numpy(), codes, f["scale"].to_numpy(), f["len"].to_numpy(), f["res"].to_numpy())


def _search(k: int, chunk: int = 4_096):
    """Survivors of a tile with their least and greatest cosine. Rows come in chunks; each query keeps a heap of its k
    greatest lower bounds, and what cannot reach the least of them is dropped."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {"id": [], "neighbour": [], "low": [], "high": []}
        if len(queries) and len(rows):
            ask, base = _coded_rows(queries), _coded_rows(rows)
            heap = np.full((len(ask.ids), k), -2.0, dtype=np.float32)
            for at in range(0, len(base.ids), chunk):
                part = base[at : at + chunk]
                dots, bound = product(ask, part)
                dots[ask.ids[:, None] == part.ids[None, :]] = -9.0
                low = dots - bound
                top = np.partition(low, low.shape[1] - k, axis=1)[:, -k:] if low.shape[1] > k else low
                heap = -np.partition(-np.hstack([heap, top]), k - 1, axis=1)[:, :k]
                i, j = np.nonzero(dots + bound >= np.maximum(heap.min(axis=1), -2.0)[:, None])
                for name, got in (("id", i), ("neighbour", part.ids[j]), ("low", low[i, j]), ("high", dots[i, j] + bound[i, j])):
                    out[name].append(got)
            i, high = np.concatenate(out["id"]), np.concatenate(out["high"])
            near = high >= heap.min(axis=1)[i]
            return pd.DataFrame({"id": ask.ids[i[near]], "neighbour": np.concatenate(out["neighbour"])[near], "low": np.concatenate(out["low"])[near], "high": high[near]})
        return pd.DataFrame({"id": pd.Series(dtype="int64"), "neighbour": pd.Series(dtype="int64"), "low": pd.Series(dtype="float32"), "high": pd.Series(dtype="float32")})

    return run


@dataclass
class Groups:
    """``reps``: id, v of one row per different vector, the least id. ``copies``: id, rep of all ids of those vectors that
    occur under several."""

    reps: DataFrame
    copies: DataFrame


def grouped(rows: DataFrame) -> Groups:
    groups = cut(rows.groupBy("v").agg(F.min("id").alias("id"), (F.min("id") != F.max("id")).alias("several")))
    copies = lookup_join(rows, groups.filter("several").select("v", F.col("id").alias("rep")), ["v"]).select("id", "rep").distinct()
    return Groups(groups.select("id", "v"), cut(copies))


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, row_block: int = 65_536, query_block: int = 4_096) -> DataFrame:
    """``id``, ``neighbour``, ``cosine``, ``place`` of the k most similar other rows of each query (columns id, v; the
    queries are among the rows). Exact.

    Blocks of queries meet blocks of rows, as codes; all rows may be queries. Copies of a vector are compared once and
    take part again in the last ranking, so that many equal vectors do not survive by the thousand.
    """
    rows, queries = rows.dropDuplicates(["id"]), queries.select("id").distinct()
    groups = grouped(rows)
    asked = queries.join(groups.copies, "id", "left").select("id", F.coalesce("rep", "id").alias("rep"))
    asked, seen = cut_counting(asked, n=F.count("*"))
    coded, all_ = cut_counting(groups.reps.mapInPandas(_encoded, "id bigint, code binary, scale float, len float, res float"), n=F.count("*"))
    parts = {"rb": max(1, -(-all_["n"] // row_block)), "qb": max(1, -(-seen["n"] // query_block))}
    every = lambda name: F.explode(F.sequence(F.lit(0), F.lit(parts[name] - 1)))
    own = lambda name: F.pmod(F.xxhash64("id"), F.lit(parts[name])).cast("int")
    lying = coded.withColumn("rb", own("rb")).withColumn("qb", every("qb"))
    again = coded.select(*[F.col(c).alias(c) for c in coded.columns])
    visiting = again.join(asked.select(F.col("rep").alias("id")).distinct(), "id", "left_semi").withColumn("qb", own("qb")).withColumn("rb", every("rb"))
    tiles = parts["qb"] * parts["rb"]
    spread_ = lambda df: df.repartition(tiles, "qb", "rb").groupBy("qb", "rb")
    survivors = spread_(visiting).cogroup(spread_(lying)).applyInPandas(_search(k), "id bigint, neighbour bigint, low float, high float")
    by_low = W.partitionBy("id").orderBy(F.desc("low"), "neighbour")
    bar = F.max(F.when(F.col("_r") == k, F.col("low"))).over(W.partitionBy("id"))
    left = cut(survivors.withColumn("_r", F.row_number().over(by_low)).withColumn("_bar", bar).filter(F.col("_bar").isNull() | (F.col("high") >= F.col("_bar"))).select("id", "neighbour"))
    v = lambda name, as_: groups.reps.select(F.col("id").alias(name), F.col("v").alias(as_))
    exact = left.join(v("id", "a"), "id").join(v("neighbour", "b"), "neighbour").select(F.col("id").alias("rep"), "neighbour", exact_cosine(F.col("a"), F.col("b")).alias("cosine"))
    # the least ids of each group of copies; no query needs more of one than k besides itself
    few = groups.copies.withColumn("_r", F.row_number().over(W.partitionBy("rep").orderBy("id"))).filter(F.col("_r") <= k + 1).select("rep", F.col("id").alias("member"))
    others = exact.join(few.select(F.col("rep").alias("neighbour"), "member"), "neighbour", "left").select("rep", F.coalesce("member", "neighbour").alias("neighbour"), "cosine")
    same = few.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", F.col("member").alias("neighbour"), F.lit(1.0).alias("cosine"))
    best = W.partitionBy("id").orderBy(F.desc("cosine"), "neighbour")
    met = asked.join(others.union(same), "rep").filter("id <> neighbour").select("id", "neighbour", "cosine")
    return met.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)


# ---------------------------------------------------------------- all pairs from a least cosine on


@dataclass
class Cells:
    """Random cross-polytope partitions: a cell is the signed axis of the largest coordinate under each rotation."""

    axes: tuple[int, ...]
    tables: int
    dims: int = DIMS
    seed: int = SEED

    def rotations(self) -> list[list[np.ndarray]]:
        rng = np.random.default_rng(self.seed)
        return [[np.linalg.qr(rng.standard_normal((self.dims, self.dims)))[0][:, :m] for m in self.axes] for _ in range(self.tables)]

    @staticmethod
    def of(x: np.ndarray, rotations: list[np.ndarray]) -> np.ndarray:
        cell = np.zeros(len(x), dtype=np.int64)
        for r in rotations:
            y = x @ r
            axis = np.abs(y).argmax(axis=1)
            cell = cell * (2 * r.shape[1]) + 2 * axis + (y[np.arange(len(x)), axis] > 0)
        return cell


def plan_cells(rows: int, min_cosine: float, dims: int = DIMS) -> Cells:
    """Cells of about ``CELL_ROWS`` rows, and as many partitions as ``MISS`` asks for at the threshold."""
    want, axes = max(1.0, rows / CELL_ROWS), []
    while want > 1 and len(axes) < 4:
        m = int(min(dims, max(1, round(want / 2))))
        axes.append(m)
        want /= 2 * m
    if not axes:
        return Cells((), 1, dims)
    rng = np.random.default_rng(SEED + 1)
    a = unit(rng.standard_normal((20_000, dims)))
    o = rng.standard_normal(a.shape)
    o = unit(o - (o * a).sum(1, keepdims=True) * a)
    b = min_cosine * a + np.sqrt(1 - min_cosine**2) * o
    one = Cells(tuple(axes), 1, dims).rotations()[0]
    meet = (Cells.of(a, one) == Cells.of(b, one)).mean()
    return Cells(tuple(axes), int(np.ceil(np.log(MISS) / np.log(1 - min(meet, 0.999)))), dims)


def _code(cells: Cells):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rotations = cells.rotations()
        for frame in frames:
            if not len(frame):
                continue
            x = unit(_matrix(frame["v"]))
            codes, scale, length, residual = quantise(x)
            raw = [c.tobytes() for c in codes]
            for t, r in enumerate(rotations):
                yield pd.DataFrame({"t": t, "cell": Cells.of(x, r), "id": frame["id"], "code": raw, "scale": scale.astype("float32"), "len": length.astype("float32"), "res": residual.astype("float32")})

    return run


def _tile(min_cosine: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        first = (frame["own"] == frame["low"]).to_numpy()
        a = _coded_rows(frame[first])
        b = a if (frame["low"].iloc[0] == frame["high"].iloc[0]) else _coded_rows(frame[~first])
        left, right = [], []
        for at in range(0, len(a.ids), 1024):
            part = a[at : at + 1024]
            dots, bound = product(part, b)
            dots += bound
            i, j = np.nonzero(dots >= min_cosine)
            x, y = part.ids[i], b.ids[j]
            keep = x < y if b is a else x != y
            left.append(np.minimum(x, y)[keep])
            right.append(np.maximum(x, y)[keep])
        return pd.DataFrame({"a": np.concatenate(left) if left else np.zeros(0, "int64"), "b": np.concatenate(right) if right else np.zeros(0, "int64")})

    return run


def exact_cosine(x: Column, y: Column) -> Column:
    """In double precision; the vectors are scaled by their largest entries first, so nothing overflows."""
    scaled = lambda v: F.transform(v, lambda e: e.cast("double") / F.array_max(F.transform(v, lambda z: F.abs(z.cast("double")))))
    a, b = scaled(x), scaled(y)
    total = lambda u, w: F.aggregate(F.zip_with(u, w, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    return total(a, b) / F.sqrt(total(a, a) * total(b, b))


@dataclass
class Similar:
    """``pairs``: a, b, cosine between representatives of different vectors; ``copies``: the members they stand for."""

    pairs: DataFrame
    copies: DataFrame


def similar_pairs(rows: DataFrame, min_cosine: float, cells: Cells | None = None) -> Similar:
    """Pairs from ``min_cosine`` on of ``rows`` (columns id, v), copies as membership: nothing is listed twice."""
    groups = grouped(rows)
    reps, copies = groups.reps, groups.copies
    cells = cells or plan_cells(reps.count(), min_cosine)
    schema = "t int, cell bigint, id bigint, code binary, scale float, len float, res float"
    coded = cut(reps.mapInPandas(_code(cells), schema))
    counts = coded.groupBy("t", "cell").agg(F.count("*").alias("rows")).withColumn("blocks", F.ceil(F.col("rows") / BLOCK)).filter("rows > 1")
    counts, seen = cut_counting(counts, rows=F.sum(F.col("rows") * F.col("blocks")))
    tasks = max(coded.sparkSession.sparkContext.defaultParallelism, -(-(seen["rows"] or 0) // TASK_ROWS))
    counts = counts.select("t", "cell", "blocks")
    lying = coded.join(counts, ["t", "cell"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    meeting = lying.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    meeting = meeting.withColumn("low", F.least("own", "block")).withColumn("high", F.greatest("own", "block"))
    meeting = meeting.repartition(tasks, "t", "cell", "low", "high")
    survivors = meeting.groupBy("t", "cell", "low", "high").applyInPandas(_tile(min_cosine), "a bigint, b bigint").distinct()
    survivors = cut(survivors)
    exact = (
        survivors.join(reps.select(F.col("id").alias("a"), F.col("v").alias("va")), "a").join(reps.select(F.col("id").alias("b"), F.col("v").alias("vb")), "b")
        .select("a", "b", exact_cosine(F.col("va"), F.col("vb")).alias("cosine")).filter(F.col("cosine") >= min_cosine)
    )
    return Similar(exact, copies)


def all_pairs(s: Similar) -> DataFrame:
    """``a``, ``b`` (a < b) of all ids, copies expanded."""
    name = s.copies
    near = s.pairs.join(name.select(F.col("rep").alias("a"), F.col("id").alias("xa")), "a", "left").join(name.select(F.col("rep").alias("b"), F.col("id").alias("xb")), "b", "left")
    near = near.select(F.coalesce("xa", "a").alias("x"), F.coalesce("xb", "b").alias("y"))
    same = name.select(F.col("id").alias("x"), "rep").join(name.select(F.col("id").alias("y"), "rep"), "rep").filter("x < y").select("x", "y")
    return near.union(same).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a <> b").distinct()
