"""Closures, levels, bucket assignment and bounded walks over link tables, all as joins."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.runtime import cut, cut_counting, drop_cut

# ---------------------------------------------------------------- class hierarchies


def hierarchy_edges(triples: DataFrame, namespace: str, subclass: str, equivalent: str | None = None) -> DataFrame:
    """``c``, ``p`` of subclass triples within a namespace; equivalences count both ways; no loops."""
    inside = triples.filter(F.col("s").startswith(namespace) & F.col("o").startswith(namespace) & (F.col("s") != F.col("o")))
    up = inside.filter(F.col("p") == subclass).select(F.col("s").alias("c"), F.col("o").alias("p"))
    if equivalent:
        same = inside.filter(F.col("p") == equivalent)
        up = up.union(same.select("s", "o")).union(same.select("o", "s"))
    return up.distinct()


def levels(edges: DataFrame) -> DataFrame:
    """``c``, ``a``, ``depth``: every ancestor with its least distance, cycles included, the class itself left out.

    Distances double each round, so the rounds are the logarithm of the longest one.
    """
    measures = {"n": F.count("*"), "sum": F.sum("depth")}
    far, state = cut_counting(edges.filter("c <> p").select("c", F.col("p").alias("a"), F.lit(1).alias("depth")).distinct(), **measures)
    before = None
    while state != before:
        hop = far.join(far.select(F.col("c").alias("a"), F.col("a").alias("b"), F.col("depth").alias("more")), "a")
        longer = hop.select("c", F.col("b").alias("a"), (F.col("depth") + F.col("more")).alias("depth")).filter("c <> a")
        before = state
        nxt, state = cut_counting(far.union(longer).groupBy("c", "a").agg(F.min("depth").alias("depth")), **measures)
        drop_cut(far)
        far = nxt
    return far


def closure(edges: DataFrame) -> DataFrame:
    """``c``, ``a``: all ancestors, without the class itself."""
    return levels(edges).select("c", "a")


def assign_buckets(classes: DataFrame, level: DataFrame, roots: DataFrame) -> DataFrame:
    """``cls``, ``bucket``: the bucket whose root is nearest going up; at equal distance the one listed first.

    ``roots``: root, bucket, ord. A root listed twice belongs to the earlier bucket. Classes without a root above
    them, and no root themselves, are left out.
    """
    own = classes.select("cls", F.col("cls").alias("a"), F.lit(0).alias("depth"))
    ways = own.union(level.select(F.col("c").alias("cls"), "a", "depth"))
    hits = ways.join(roots.withColumnRenamed("root", "a"), "a")
    return hits.groupBy("cls").agg(F.min_by("bucket", F.struct("depth", "ord")).alias("bucket"))


def inferred_types(instances: DataFrame, ancestors: DataFrame) -> DataFrame:
    """``iri``, ``type``: asserted types and, for each of them, all its ancestors (instances: iri, type, distinct)."""
    up = instances.join(ancestors.select(F.col("c").alias("type"), "a"), "type").select("iri", F.col("a").alias("type"))
    return instances.select("iri", "type").union(up)


def extent(inferred: DataFrame, cls: str) -> DataFrame:
    """``iri``: the members of a class, by asserted or inferred type."""
    return inferred.filter(F.col("type") == cls).select("iri").distinct()


# ---------------------------------------------------------------- bounded walks to canonical places


def walk(edges: DataFrame, canonical: DataFrame, predicates: list[str], max_hops: int) -> DataFrame:
    """``x``, ``place``: the canonical places each node reaches within ``max_hops`` links.

    A canonical node is its own place. Any other takes, among its predicates in order, the first by which some
    neighbour other than itself resolves within the hops left, and all places that one gives. One join and one
    aggregation per hop, never a walk per node. ``edges``: s, p, o; ``canonical``: x, place.
    """
    order = F.coalesce(*[F.when(F.col("p") == p, F.lit(i)) for i, p in enumerate(predicates)])
    steps = edges.filter(F.col("p").isin(predicates) & (F.col("s") != F.col("o"))).select("s", order.alias("prio"), "o").distinct()
    steps = cut(steps.join(canonical.select(F.col("x").alias("s")), "s", "left_anti"))
    fixed = canonical.select("x", "place").distinct()
    reach = fixed
    for _ in range(max_hops):
        got = steps.join(reach.select(F.col("x").alias("o"), "place"), "o").select("s", "prio", "place").distinct()
        first = got.groupBy(F.col("s").alias("x")).agg(F.min("prio").alias("prio"))
        reach = cut(fixed.union(got.join(first, (F.col("s") == F.col("x")) & (got["prio"] == first["prio"])).select("x", "place")))
    return reach


@dataclass
class Property:
    """One property of a group; ``inherit`` resolves the value entity by its own groups' properties, in order."""

    predicate: str
    inherit: tuple[str, ...] = ()


@dataclass
class Resolution:
    groups: dict[str, list[Property]] = field(default_factory=dict)


def resolve(entities: DataFrame, edges: DataFrame, places: DataFrame, rules: Resolution) -> DataFrame:
    """``x``, ``places`` (sorted), ``via``: each entity by the first of its group's properties that resolves.

    An entity that is itself canonical resolves to itself, via ``self``. ``entities``: x, grp; ``places``: x, place
    with the walk's results; inherited properties look at the value one level deep.

    The rules are a small table (group, property, place in order) joined to the links once; only the values of
    inheriting properties are looked at a second time. The first place in order is a minimum, not a join back.
    """
    spark = entities.sparkSession
    listed = [(g, p.predicate, i, p.inherit) for g, props in rules.groups.items() for i, p in enumerate(props)]
    order = spark.createDataFrame([(g, p, i, bool(up)) for g, p, i, up in listed], "grp string, p string, ord int, inherits boolean")
    steps = cut(edges.filter(F.col("p").isin(sorted({p for _, p, _, _ in listed}))).select("s", "p", "o").distinct())
    self_ = entities.select("x").join(places.filter(F.col("x") == F.col("place")), "x").select("x", "place").distinct()
    mine = cut(entities.join(self_.select("x"), "x", "left_anti").join(steps.withColumnRenamed("s", "x"), "x").join(F.broadcast(order), ["grp", "p"]))
    at = places.select(F.col("x").alias("o"), "place")
    found = mine.filter("not inherits").join(at, "o").select("x", "grp", "ord", "p", "place")
    inherits = [(g, p, j, of) for g, p, _, up in listed for j, of in enumerate(up)]
    if inherits:
        ways = spark.createDataFrame(inherits, "grp string, p string, j int, of string")
        values = mine.filter("inherits").join(F.broadcast(ways), ["grp", "p"]).select("x", "grp", "ord", "p", "o", "j", "of")
        direct = order.filter("not inherits").select(F.col("grp").alias("of"), F.col("p").alias("q"), F.col("ord").alias("k"))
        ahead = values.select("o", "of").distinct().join(steps.select(F.col("s").alias("o"), F.col("p").alias("q"), F.col("o").alias("v")), "o").join(F.broadcast(direct), ["of", "q"])
        reached = ahead.join(places.select(F.col("x").alias("v"), "place"), "v").groupBy("o", "of", "k").agg(F.collect_set("place").alias("ps"))
        first = reached.groupBy("o", "of").agg(F.min_by("ps", "k").alias("ps"))
        best = values.join(first, ["o", "of"]).groupBy("x", "grp", "ord", "p", "o").agg(F.min_by("ps", "j").alias("ps"))
        found = found.union(best.select("x", "grp", "ord", "p", F.explode("ps")))
    by_property = found.groupBy("x", "grp", "ord").agg(F.collect_set("place").alias("ps"), F.min("p").alias("via"))
    chosen = by_property.groupBy("x", "grp").agg(F.min_by(F.struct("ps", "via"), "ord").alias("b")).select("x", F.explode("b.ps").alias("place"), "b.via")
    out = self_.select("x", "place", F.lit("self").alias("via")).union(chosen)
    return out.groupBy("x").agg(F.array_sort(F.collect_set("place")).alias("places"), F.min("via").alias("via"))


def decide(entities: DataFrame, resolved: DataFrame, target: list[str], min_editions: int) -> DataFrame:
    """``x``, ``passes``, ``reason``, ``places``: target hits pass; unresolved entities pass with enough editions.

    ``entities``: x, editions.
    """
    all_ = entities.join(resolved, "x", "left").withColumn("hits", F.array_intersect(F.coalesce("places", F.array().cast("array<string>")), F.array(*[F.lit(t) for t in target])))
    known, hit = F.col("places").isNotNull(), F.size("hits") > 0
    reason = F.when(hit, F.col("via")).when(known, "non_target_country").when(F.col("editions") >= min_editions, "unresolved_editions").otherwise("unresolved")
    return all_.select("x", (hit | (~known & (F.col("editions") >= min_editions))).alias("passes"), reason.alias("reason"), F.array_sort("hits").alias("places"))


# ---------------------------------------------------------------- ontology axioms


@dataclass(frozen=True)
class Profile:
    """What the target profile forbids: predicates, types of axioms, and predicates inside class expressions."""

    predicates: frozenset[str]
    types: frozenset[str]
    expression: frozenset[str]
    rdf_type: str


def split_profile(triples: DataFrame, profile: Profile) -> DataFrame:
    """Every triple, other columns kept, with ``reason`` (null: kept). A blank node is bad if it carries a forbidden
    predicate of an expression or a forbidden type, or refers to a bad blank node; a triple of a bad node, or one that
    points at it, is removed."""
    t = triples.withColumn("_id", F.xxhash64("s", "p", "o"))
    is_blank = lambda c: F.col(c).startswith("_:")
    bad = cut(t.filter(is_blank("s") & (F.col("p").isin(*profile.expression) | ((F.col("p") == profile.rdf_type) & F.col("o").isin(*profile.types)))).select(F.col("s").alias("b")).distinct())
    links = cut(t.filter(is_blank("s") & is_blank("o")).select("s", "o").distinct())
    before, n = -1, bad.count()
    while n != before:
        up = links.join(bad.select(F.col("b").alias("o")), "o").select(F.col("s").alias("b"))
        before = n
        bad, seen = cut_counting(bad.union(up).distinct(), n=F.count("*"))
        n = seen["n"]
    marked = t.join(bad.select(F.col("b").alias("s"), F.lit(True).alias("_s")), "s", "left").join(bad.select(F.col("b").alias("o"), F.lit(True).alias("_o")), "o", "left")
    reason = (
        F.when(F.col("p").isin(*profile.predicates), F.concat(F.lit("predicate:"), F.col("p")))
        .when((F.col("p") == profile.rdf_type) & F.col("o").isin(*profile.types), F.concat(F.lit("type:"), F.col("o")))
        .when(F.col("_s"), "in_expression").when(F.col("_o"), "points_at_expression")
    )
    return marked.select(*triples.columns, reason.alias("reason"))


def clean_axioms(triples: DataFrame, rules: list[tuple[str, Column]], declared: DataFrame | None = None) -> DataFrame:
    """Every triple, other columns kept, with the first ``rule`` that removes it (null: kept). With ``declared`` (cls), rules may use the
    column ``o_declared``."""
    t = triples
    if declared is not None:
        t = t.join(declared.select(F.col("cls").alias("o"), F.lit(True).alias("o_declared")).distinct(), "o", "left").withColumn("o_declared", F.coalesce("o_declared", F.lit(False)))
    rule = None
    for name, test in rules:
        rule = F.when(test, name) if rule is None else rule.when(test, name)
    return t.select(*triples.columns, rule.alias("rule"))


# ---------------------------------------------------------------- comparison


def two_way_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of only one side, with ``side``."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).union(right.exceptAll(left).withColumn("side", F.lit("right")))


def top_per_group(df: DataFrame, group: str, order: list, n: int) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(W.partitionBy(group).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")
