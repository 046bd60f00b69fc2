"""Checks on finished tiers, each an aggregate with a row in a report, and the gate before a release."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.operators.vectors import norm
from terrace.sources.ntriples import file_digest

CONFORMING = r"^https?://[^\s<>\"{}|\\^`]+\z"


def tier_report(ranked: DataFrame, tiers: list[int]) -> DataFrame:
    """``tier``, ``check``, ``passed``: size, unique iris, conforming iris, dense ranks, ranks within the tier, nesting.

    ``ranked``: iri, rank, tier_min. All tiers in one conditional aggregate over rows and one each over iris and ranks.
    """
    of = lambda t, value: F.when(F.col("rank") <= t, value)
    odd = ~F.coalesce(F.col("iri").rlike(CONFORMING), F.lit(False))
    rows = ranked.agg(F.array(*[
        F.struct(
            F.lit(t).alias("tier"), F.count_if(F.col("rank") <= t).alias("n"), F.coalesce(F.max(of(t, F.col("rank"))), F.lit(0)).alias("last"), F.coalesce(F.min(of(t, F.col("rank"))), F.lit(1)).alias("first"),
            F.count_if((F.col("rank") <= t) & odd).alias("odd"), F.coalesce(F.max(of(t, F.col("tier_min"))), F.lit(0)).alias("most"),
        ) for t in tiers
    ]).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    by_iri = ranked.groupBy("iri").agg(F.min("rank").alias("rank"), F.min("tier_min").alias("least"))
    before = dict(zip(tiers[1:], tiers))
    lost = lambda t: (F.col("least") <= before.get(t, -1)) & ~F.coalesce(F.col("rank") <= t, F.lit(False))
    iris = by_iri.agg(F.array(*[F.struct(F.lit(t).alias("tier"), F.count_if((F.col("rank") <= t) & F.col("iri").isNotNull()).alias("iris"), F.count_if(lost(t)).alias("lost")) for t in tiers]).alias("r"))
    ranks = ranked.groupBy("rank").agg(F.lit(1)).agg(F.array(*[F.struct(F.lit(t).alias("tier"), F.count_if(F.col("rank") <= t).alias("ranks")) for t in tiers]).alias("r"))
    a = rows
    for more in (iris, ranks):
        a = a.join(more.select(F.explode("r").alias("r")).select("r.*"), "tier")
    checks = {
        "full": F.col("n") == F.col("tier"), "unique": F.col("n") == F.col("iris"), "conforming": F.col("odd") == 0,
        "dense": (F.col("ranks") == F.col("n")) & (F.col("first") == 1) & (F.col("last") == F.col("n")), "within": F.col("most") <= F.col("tier"),
    }
    holds = [F.when(F.col("tier") == t, F.struct(F.lit(f"holds_{last}").alias("check"), (F.col("lost") == 0).alias("passed"))) for t, last in before.items()]
    each = F.array(*[F.struct(F.lit(k).alias("check"), v.alias("passed")) for k, v in checks.items()], *holds)
    return a.select("tier", F.explode(F.array_compact(each)).alias("c")).select("tier", "c.check", "c.passed")


def entity_report(ents: DataFrame, types: DataFrame, dims: int, tolerance: float = 1e-3) -> DataFrame:
    """``tier``, ``check``, ``passed`` on whole rows of all tiers at once: abstracts that say something, at least one type,
    vectors of the right length and of unit norm, and asserted types that are declared.

    ``ents``: tier, iri, abstract, types, vector; ``types``: cls, the declared classes (empty: no check)."""
    v = F.col("vector")
    right = F.coalesce(F.size(v) == dims, F.lit(False))
    unit = F.coalesce(F.abs(norm(v) - 1) <= tolerance, F.lit(False))
    said, typed = F.coalesce(F.char_length("abstract") > 0, F.lit(False)), F.coalesce(F.size("types") > 0, F.lit(False))
    rows = ents.groupBy("tier").agg(*[F.count_if(~ok).alias(k) for k, ok in {"abstracts": said, "types": typed, "dims": right, "unit_vectors": right & unit}.items()])
    loose = ents.select("tier", F.explode("types").alias("cls")).distinct().join(types, "cls", "left_anti").groupBy("tier").agg(F.count("*").alias("declared_types"))
    if not types.limit(1).count():
        loose = loose.limit(0)
    both = rows.join(loose, "tier", "left").fillna(0, ["declared_types"])
    names = ["abstracts", "types", "dims", "unit_vectors", "declared_types"]
    each = F.array(*[F.struct(F.lit(k).alias("check"), (F.col(k) == 0).alias("passed")) for k in names])
    return both.select("tier", F.explode(each).alias("c")).select("tier", "c.check", "c.passed")


def same_vectors(small: DataFrame, large: DataFrame) -> bool:
    """Do the members of a tier (iri, vector) have the same vectors in the next?"""
    of = lambda df, name: df.select("iri", F.xxhash64("vector").alias(name))
    return not of(small, "a").join(of(large, "b"), "iri", "left").filter(~F.col("a").eqNullSafe(F.col("b"))).limit(1).count()


def bucket_shares(ranked: DataFrame, shares: dict[str, float], tolerance: float, total: int) -> DataFrame:
    """``bucket``, ``share``, ``wanted``, ``near``: a soft check on the shares reached of ``total`` rows."""
    spark = ranked.sparkSession
    wanted = spark.createDataFrame(list(shares.items()), "bucket string, wanted double")
    counts = ranked.groupBy("bucket").agg(F.count("*").alias("n"))
    rows = wanted.join(counts, "bucket", "left")
    share = F.coalesce("n", F.lit(0)) / max(total, 1)
    return rows.select("bucket", share.alias("share"), "wanted", (F.abs(share - F.col("wanted")) <= tolerance).alias("near"))


def release_gate(folder: str) -> list[dict]:
    """Problems that forbid a release: manifest, report, card or attribution missing, checks not passed, a card without
    licence, no files or files missing or changed, tiers not ascending in name order, tiers of different configurations or
    embedding runs, a test embedder. An empty list means go."""
    root, problems = Path(folder), []
    say = lambda check, why: problems.append({"check": check, "why": why})
    if not (root / "manifest.json").is_file():
        say("manifest", "missing")
        return problems
    manifest = json.loads((root / "manifest.json").read_text())
    if manifest.get("embedder", "seeded") == "seeded":
        say("embedder", "vectors come from the test embedder")
    report = root / "report.json"
    if not report.is_file():
        say("report", "missing")
    else:
        for row in json.loads(report.read_text()):
            if not row["passed"]:
                say("report", f"{row['check']} failed")
    for name, want in manifest.get("files", {}).items():
        path = root / name
        if not path.is_file():
            say("files", f"{name} missing")
        elif path.stat().st_size != want["bytes"]:
            say("files", f"{name} has another size")
        elif file_digest(path) != want["sha256"]:
            say("files", f"{name} has another digest")
    if not manifest.get("files"):
        say("files", "none listed")
    card = root / "README.md"
    if not card.is_file():
        say("card", "missing")
    elif not card.read_text().startswith("---\n") or "license:" not in card.read_text().split("---")[1]:
        say("card", "no licence")
    if not (root / "ATTRIBUTION.md").is_file():
        say("attribution", "missing")
    for key in ("config_sha256", "embedding_run"):
        if len({str(t.get(key)) for t in manifest.get("tiers", [])}) > 1:
            say(key, "differs between tiers")
    counts = [t["count"] for t in sorted(manifest.get("tiers", []), key=lambda t: int(t["name"].lstrip("t")))]
    if not counts or any(a >= b for a, b in zip(counts, counts[1:])):
        say("tiers", "sizes do not ascend")
    return problems
