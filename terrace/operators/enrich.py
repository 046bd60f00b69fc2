"""Candidates, redirects, property pivots, labels, edges and the wide entity row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import collapse_space, lenient_double, lenient_long


def first_of(df: DataFrame, key: str, *values: str) -> DataFrame:
    """One row per key: the least row of values, so the choice does not depend on the order of rows."""
    return df.groupBy(key).agg(F.min(F.struct(*values)).alias("_v")).select(key, *[F.col(f"_v.{v}").alias(v) for v in values])


def candidates(types: DataFrame, abstracts: DataFrame, noise: list[DataFrame], buckets: DataFrame, prefixes: list[str], min_chars: int) -> DataFrame:
    """``iri``, ``title``, ``type``, ``bucket``, ``abstract``: typed entities with a long enough abstract, without
    noise pages (tables of ``iri``) and without titles of the given prefixes."""
    typed = first_of(types, "iri", "type")
    texts = first_of(abstracts.select("iri", "title", collapse_space(F.col("abstract")).alias("abstract")).filter(F.char_length("abstract") >= min_chars), "iri", "abstract", "title")
    out = typed.join(texts, "iri")
    for page in noise:
        out = out.join(page.select("iri"), "iri", "left_anti")
    for prefix in prefixes:
        out = out.filter(~F.col("title").startswith(prefix))
    return out.join(buckets, "type").select("iri", "title", "type", "bucket", "abstract")


def canonical_objects(edges: DataFrame, redirects: DataFrame) -> DataFrame:
    """Objects replaced by their redirect's target, one hop; several targets give several rows."""
    to = redirects.select(F.col("source").alias("o"), "target")
    return edges.join(to, "o", "left").select("s", "p", F.coalesce("target", "o").alias("o"))


def typed_value(value: Column, kind: str) -> Column:
    return {"int": lenient_long, "float": lenient_double}.get(kind, lambda v: v)(value)


def pivot_properties(literals: DataFrame, names: dict[str, tuple[str, str]], keys: DataFrame | None = None) -> DataFrame:
    """``iri`` and one typed column per property of ``names`` (predicate -> column, kind), in order of column.

    The columns come from configuration, never from the data. Of several values the least text is taken.
    """
    rows = literals.filter(F.col("p").isin(list(names)))
    if keys is not None:
        rows = rows.join(keys.select(F.col("iri").alias("s")), "s", "left_semi")
    column = F.coalesce(*[F.when(F.col("p") == p, F.lit(c)) for p, (c, _) in names.items()])
    one = rows.select(F.col("s").alias("iri"), column.alias("name"), "o")
    columns = sorted({c for c, _ in names.values()})
    kind = {c: k for c, k in names.values()}
    wide = one.groupBy("iri").pivot("name", columns).agg(F.min("o"))
    return wide.select("iri", *[typed_value(F.col(f"`{c}`"), kind[c]).alias(c) for c in columns])


def whitelisted(rows: DataFrame, members: DataFrame, allowed: list[tuple[str, str]]) -> DataFrame:
    """Rows (s, p, ...) of those properties that the group of their subject may have.

    ``members``: iri, grp; ``allowed``: pairs of group and predicate from the configuration."""
    pairs = rows.sparkSession.createDataFrame(allowed, "grp string, p string").distinct()
    of = rows.join(members.select(F.col("iri").alias("s"), "grp"), "s")
    return of.join(F.broadcast(pairs), ["grp", "p"], "left_semi").select(rows.columns)


def props_struct(wide: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``iri``, ``props``: literal columns in order of name, then label lists."""
    literal = sorted(c for c in wide.columns if c != "iri")
    listed = sorted(c for c in labels.columns if c != "iri") if labels is not None else []
    joined = wide.join(labels, "iri", "full") if labels is not None else wide
    return joined.select("iri", F.struct(*literal, *listed).alias("props"))


def object_labels(edges: DataFrame, names: dict[str, str], label: Column) -> DataFrame:
    """``iri``, ``name``, ``labels``: sorted labels of the objects by property, repeats kept."""
    column = F.coalesce(*[F.when(F.col("p") == p, F.lit(c)) for p, c in names.items()])
    rows = edges.filter(F.col("p").isin(list(names))).select(F.col("s").alias("iri"), column.alias("name"), label.alias("label"))
    return rows.groupBy("iri", "name").agg(F.array_sort(F.collect_list("label")).alias("labels"))


def edges_within(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Links both of whose ends are members (``iri``)."""
    return edges.join(members.select(F.col("iri").alias("s")), "s", "left_semi").join(members.select(F.col("iri").alias("o")), "o", "left_semi")


def assemble(ranked: DataFrame, *parts: DataFrame) -> DataFrame:
    """The wide entity row: left joins on iri, in order of the parts."""
    out = ranked
    for part in parts:
        out = out.join(part, "iri", "left")
    return out
