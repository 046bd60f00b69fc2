"""Attribute-value rows into wide tables: one row per entity, one typed column per attribute.

1. Rows meet the fixed attribute table (broadcast, at most ``MAX_ATTRIBUTES`` rows, checked) and are typed.
2. One partial-aggregated shuffle makes cells (entity, column) with their least and greatest value, so neither a hot
   entity nor a hot attribute gathers its rows in one task. The cells are written partitioned by column: each
   partition is one narrow typed table.
3. The narrow tables lie in buckets by entity, their number by the number of rows, and are outer-joined in a balanced
   tree of fan-in ``FAN_IN``, each node against the entity spine. All tables share the buckets, so a node of the tree is
   one stage and nothing is shuffled again; the fan-in bounds the sorts that share a task's memory.

Defined results: unreadable or null values give no value; an entity all of whose values are unreadable keeps a row
of nulls; a cell with several different values takes the least and is listed in ``conflicts``; repeated rows change
nothing; rows with a null subject, or with a predicate no column is known for, are left out of the wide table; an
empty table gives an empty result with all columns; further input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import percent_decode, strip_space
from terrace.operators.badrows import DATE, DOUBLE
from terrace.runtime import cut_bucketed, full_match

MAX_ATTRIBUTES = 10_000
FAN_IN = 5
BUCKET_ROWS = 2_000_000
SPARK_TYPES = {"int": "bigint", "float": "double", "date": "date", "string": "string"}
_SLOT = {"int": "i", "float": "f", "date": "d", "string": "t"}


def plain_subject(s: Column) -> Column:
    """http form, percent-decoded, without trailing slashes."""
    http = F.when(s.startswith("https://"), F.concat(F.lit("http"), F.substr(s, F.lit(6)))).otherwise(s)
    decoded = percent_decode(http)
    return F.when(decoded.endswith("/"), F.regexp_replace(decoded, r"(?<=[^/:])/+\z", "")).otherwise(decoded)


@dataclass
class Attribute:
    colname: str
    coltype: str


def attribute_columns(attributes: DataFrame) -> list[Attribute]:
    """The columns in order of name. The attribute table is configuration: its size is checked before it is read."""
    rows = attributes.select("colname", "coltype").distinct().orderBy("colname").limit(MAX_ATTRIBUTES + 1).collect()
    if len(rows) > MAX_ATTRIBUTES:
        raise ValueError(f"more than {MAX_ATTRIBUTES} attributes")
    named = [Attribute(r.colname, r.coltype) for r in rows if r.colname is not None and r.coltype in SPARK_TYPES]
    if len({a.colname for a in named}) < len(named):
        raise ValueError("one column has two types")
    return named


def typed_slots(text: Column, coltype: Column) -> list[Column]:
    """Four typed columns of which the one for ``coltype`` is set where the text, trimmed before, is readable."""
    whole = F.regexp_extract(text, r"^([+-]?[0-9]+)(?:\.0+)?\z", 1)
    return [
        F.when(coltype == "int", F.nullif(whole, F.lit("")).try_cast("bigint")).alias("i"),
        F.when((coltype == "float") & full_match(text, DOUBLE), text.try_cast("double") + F.lit(0.0)).alias("f"),
        F.when((coltype == "date") & full_match(text, DATE) & ~text.startswith("0000"), text.try_cast("date")).alias("d"),
        F.when((coltype == "string") & (text != ""), text).alias("t"),
    ]


def cells(literals: DataFrame, attributes: DataFrame) -> DataFrame:
    """One row per (entity, column): least value in the slot of its type and whether there are others."""
    known = attributes.select(F.col("p").alias("_p"), "colname", "coltype").distinct()
    if known.limit(MAX_ATTRIBUTES + 1).count() > MAX_ATTRIBUTES:
        raise ValueError(f"more than {MAX_ATTRIBUTES} attributes")
    rows = literals.filter(F.col("s").isNotNull()).select(plain_subject(F.col("s")).alias("s"), F.col("p").alias("_p"), strip_space(F.col("o")).alias("o"))
    typed = rows.join(F.broadcast(known), "_p").select("s", "colname", *typed_slots(F.col("o"), F.col("coltype")))
    least = [F.min(c).alias(c) for c in _SLOT.values()]
    several = [F.coalesce(F.min(c) != F.max(c), F.lit(False)) for c in _SLOT.values()]
    conflict = several[0]
    for one in several[1:]:
        conflict = conflict | one
    return typed.groupBy("s", "colname").agg(*least, conflict.alias("conflict"))


def widen(literals: DataFrame, attributes: DataFrame) -> DataFrame:
    """``s``, one typed column per attribute column in order of name, ``conflicts`` (sorted column names)."""
    columns = attribute_columns(attributes)
    spark = literals.sparkSession
    buckets = max(spark.sparkContext.defaultParallelism, -(-literals.count() // BUCKET_ROWS))
    narrow = cut_bucketed(cells(literals, attributes), buckets, "s", partition_by="colname")
    spine = cut_bucketed(narrow.select("s").distinct(), buckets, "s", placed=True)

    def leaf(a: Attribute) -> DataFrame:
        mine = narrow.filter(F.col("colname") == a.colname)
        flag = F.when(F.col("conflict"), F.array(F.lit(a.colname))).otherwise(F.array().cast("array<string>"))
        return mine.select("s", F.struct(F.col(_SLOT[a.coltype]).alias("v"), flag.alias("c")).alias(f"_{a.colname}"))

    columns_of = {a.colname: leaf(a) for a in columns}
    parts = list(columns_of.values())
    if not parts:
        return spine.withColumn("conflicts", F.array().cast("array<string>"))
    while True:
        joined = []
        for k in range(0, len(parts), FAN_IN):
            out = spine
            for part in parts[k : k + FAN_IN]:
                out = out.join(part, "s", "left")
            joined.append(out)
        if len(joined) == 1:
            break
        parts = [cut_bucketed(one, buckets, "s", placed=True) for one in joined]
    flags = F.flatten(F.array(*[F.coalesce(F.col(f"`_{a.colname}`.c"), F.array().cast("array<string>")) for a in columns]))
    return joined[0].select("s", *[F.col(f"`_{a.colname}`.v").alias(a.colname) for a in columns], flags.alias("conflicts"))


def conflicting_cells(wide: DataFrame) -> DataFrame:
    return wide.select("s", F.explode("conflicts").alias("colname"))
