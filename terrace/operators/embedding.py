"""Vectors from an embedding service, taken up again where a run ended.

A provider turns batches of texts into vectors, wherever it gets them from. Rows go to it in waves; each wave is written
before the next begins, so a run that fails loses one wave at most. What is there already, for the same text by the same
provider, is not asked for again: a changed text is, and only that one.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.vectors import seeded_vector

WAVE_ROWS = 100_000
BATCH_TEXTS = 512
TRIES = 6
LONGEST_WAIT = 60.0
SCHEMA = "iri string, h bigint, provider string, vector array<float>, tokens bigint"


class Provider(Protocol):
    """``name`` tells vectors of one model and size from those of another. Instances are sent to the tasks."""

    name: str
    dims: int

    def embed(self, keys: list[str], texts: list[str]) -> tuple[list[np.ndarray], int]:
        """A vector per text and the tokens used. May raise on passing troubles; the batch is then tried again."""


@dataclass(frozen=True)
class Seeded:
    """Reproducible vectors by iri, for tests without a service."""

    dims: int
    name: str = "seeded"

    def embed(self, keys: list[str], texts: list[str]) -> tuple[list[np.ndarray], int]:
        return [seeded_vector(k, self.dims) for k in keys], 0


def provider_of(name: str, dims: int) -> Provider:
    """``seeded``, or ``module:factory`` whose factory takes the size of the vectors."""
    if name == "seeded":
        return Seeded(dims)
    module, _, factory = name.partition(":")
    if not factory:
        raise ValueError(f"unknown embedding provider {name!r}")
    return getattr(importlib.import_module(module), factory)(dims)


def _unit(vector: np.ndarray, dims: int) -> np.ndarray:
    v = np.asarray(vector, dtype=np.float64)
    length = np.linalg.norm(v)
    if v.shape != (dims,) or not np.isfinite(length) or length == 0:
        raise ValueError(f"the provider gave a vector of shape {v.shape} and length {length}")
    return (v / length).astype(np.float32)


def _patiently(provider: Provider, keys: list[str], texts: list[str], tries: int, wait: float) -> tuple[list[np.ndarray], int]:
    for k in range(tries):
        try:
            return provider.embed(keys, texts)
        except Exception:  # noqa: BLE001  whatever the service's client raises
            if k + 1 == tries:
                raise
            time.sleep(min(LONGEST_WAIT, wait * 2**k))
    raise AssertionError


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(folder)


@dataclass
class Embedded:
    vectors: DataFrame
    info: dict


def embed(rows: DataFrame, provider: Provider, folder: str, wave_rows: int = WAVE_ROWS, batch: int = BATCH_TEXTS, tries: int = TRIES, wait: float = 1.0) -> Embedded:
    """``vectors``: iri, vector (of unit length) for each of ``rows`` (iri, text; null texts count as empty, repeated rows
    once). ``info``: provider, dims, count, asked (in this run), waves, tokens (of all). Raises if a row has no vector."""
    spark = rows.sparkSession
    wanted = rows.filter("iri is not null").select("iri", F.coalesce("text", F.lit("")).alias("text")).groupBy("iri").agg(F.max("text").alias("text")).withColumn("h", F.xxhash64("text"))
    mine = lambda: _stored(spark, folder).filter(F.col("provider") == provider.name)
    todo = wanted.join(mine().select("iri", "h"), ["iri", "h"], "left_anti")
    asked = todo.count()
    waves = -(-asked // wave_rows)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                vectors, tokens = _patiently(provider, part["iri"].tolist(), part["text"].tolist(), tries, wait)
                if len(vectors) != len(part):
                    raise ValueError(f"the provider gave {len(vectors)} vectors for {len(part)} texts")
                used = [tokens] + [0] * (len(part) - 1)
                yield pd.DataFrame({"iri": part["iri"], "h": part["h"], "provider": provider.name, "vector": [_unit(v, provider.dims) for v in vectors], "tokens": used})

    for k in range(waves):
        one = todo.filter(F.pmod(F.xxhash64("iri"), F.lit(waves)) == k)
        one.select("iri", "h", "text").mapInPandas(run, SCHEMA).write.mode("append").parquet(folder)
    have = wanted.select("iri", "h").join(mine(), ["iri", "h"], "left").groupBy("iri").agg(F.max("vector").alias("vector"))
    seen = have.agg(F.count("*").alias("n"), F.count("vector").alias("with")).first()
    if seen["n"] != seen["with"]:
        raise ValueError(f"{seen['n'] - seen['with']} rows have no vector")
    tokens = mine().agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    return Embedded(have, {"provider": provider.name, "dims": provider.dims, "count": seen["n"], "asked": asked, "waves": waves, "tokens": tokens})
