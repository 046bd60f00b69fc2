"""Queries of the pipeline's own operators, bound to the test tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.text import local_name, normalize_iri
from terrace.operators import checks, enrich, graph, hierarchy, ranking, vectors
from terrace.operators.ranking import Bucket
from terrace.runtime import cut, table
from terrace.sources import ntriples

RES, ONT, XSD = "http://kb.example/resource/", "http://kb.example/ontology/", "http://schema.example/xsd#"
LABEL = "http://schema.example/label"
BUCKETS = [
    Bucket(name, float(1 + i % 5))
    for i, name in enumerate((
        "academy", "boardgame", "botanist", "ceramicist", "chorister", "documentary", "essayist", "fencer", "guild", "lighthouse", "locomotive",
        "novel", "province", "radioserial", "regatta", "rowingclub", "shipyard", "songcycle", "stageactor", "village", "waterway",
    ))
]
WEIGHTS = {"views": 0.6, "languages": 0.4}
FLOORS = {"views": 5000, "languages": 5}
TIERS = [250, 500, 1000]
HOPS = 3
WALK = ["country", "isPartOf", "location"]
TARGET_LANGS = ["de", "fr", "nl", "es", "sv"]
PROPS = {
    ONT + "populationTotal": ("populationtotal", "int"), ONT + "foundingYear": ("foundingyear", "int"), ONT + "areaTotal": ("areatotal", "float"),
    ONT + "height": ("height", "float"), ONT + "birthDate": ("birthdate", "string"), ONT + "motto": ("motto", "string"),
}


def _objects(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "mappingbased_objects").filter("o_is_iri and o is not null and s is not null").select("s", "p", "o")


def _pool(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "entities")
    rows = e.select("iri", F.lower(F.trim("bucket")).alias("bucket"), F.coalesce("views", F.lit(0)).alias("views"), F.coalesce("languages", F.lit(1)).alias("languages"))
    return enrich.first_of(rows, "iri", "bucket", "views", "languages")


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return ranking.bucket_scores(_pool(spark, d), WEIGHTS)


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    return ranking.rank_entities(ranking.above_floor(_scored(spark, d), FLOORS), BUCKETS, TIERS)


# ---------------------------------------------------------------- candidates and relational operators


def candidate_pool(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "entities")
    types = e.select("iri", F.explode("types").alias("type"))
    noise = [_objects(spark, d).filter(F.col("p") == ONT + "successor").select(F.col("o").alias("iri"))]
    buckets = types.select("type").distinct().select("type", F.lower("type").alias("bucket"))
    return enrich.candidates(types, e, noise, buckets, ["The "], 40)


def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    return enrich.first_of(table(spark, d, "documents").filter("text is not null"), "text", "doc_id").select("doc_id")


def type_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entities").groupBy("bucket", "grp").agg(F.count("*").alias("n"), F.count_distinct("iri").alias("entities"))


def edition_languages(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("iri", F.lower("lang").alias("lang")).filter("iri is not null")
    return docs.groupBy("iri").agg(F.count_distinct("lang").alias("languages"), F.count_distinct(F.when(F.col("lang").isin(TARGET_LANGS), F.col("lang"))).alias("target_editions"))


def monthly_views(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM").alias("month"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("views"))


def redirect_canon(spark: SparkSession, d: str) -> DataFrame:
    edges = _objects(spark, d)
    redirects = edges.filter("o rlike '[?#]'").select(F.col("o").alias("source"), F.regexp_replace("o", "[?#].*", "").alias("target")).distinct()
    return enrich.canonical_objects(edges, redirects).groupBy("o").agg(F.count("*").alias("n"))


def country_distribution(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entities").select(F.explode("countries").alias("country")).groupBy("country").agg(F.count("*").alias("n"))


def top_titles(spark: SparkSession, d: str) -> DataFrame:
    rows = enrich.first_of(table(spark, d, "entities").filter("rank is not null and bucket is not null"), "iri", "bucket", "rank", "title")
    return graph.top_per_group(rows, "bucket", [F.col("rank"), F.col("iri")], 20).select("bucket", "rank", "title", "iri")


def edges_in_tier(spark: SparkSession, d: str) -> DataFrame:
    members = table(spark, d, "entities").filter("tier_min is not null").groupBy("iri").agg(F.min("tier_min").alias("t"))
    return enrich.edges_within(_objects(spark, d).distinct(), members)


def dangling_edges(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "entities").select(F.col("iri").alias("o"))
    return _objects(spark, d).join(known, "o", "left_anti").groupBy("p").agg(F.count("*").alias("n"))


def object_labels(spark: SparkSession, d: str) -> DataFrame:
    names = {ONT + "country": "country_label", ONT + "location": "location_label", ONT + "genre": "genre_label"}
    out = enrich.object_labels(_objects(spark, d), names, local_name(F.col("o")))
    return out.select("iri", "name", F.array_join("labels", "|").alias("labels"))


def props_pivot(spark: SparkSession, d: str) -> DataFrame:
    return enrich.pivot_properties(table(spark, d, "mappingbased_literals"), PROPS, table(spark, d, "entities").select("iri"))


def props_struct(spark: SparkSession, d: str) -> DataFrame:
    wide = enrich.pivot_properties(table(spark, d, "mappingbased_literals"), PROPS)
    labels = enrich.object_labels(_objects(spark, d), {ONT + "country": "country_label"}, local_name(F.col("o"))).select("iri", F.col("labels").alias("country_label"))
    p = enrich.props_struct(wide, labels)
    return p.select("iri", F.col("props.birthdate").alias("birthdate"), F.col("props.populationtotal").alias("populationtotal"), F.array_join("props.country_label", "|").alias("country_label"))


def wide_entities(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "entities")
    texts = enrich.first_of(e, "iri", "title")
    vecs = e.groupBy("iri").agg(F.max(F.size("vector")).alias("dims"))
    return enrich.assemble(_ranked(spark, d).select("iri", "rank", "tier_min"), texts, props_pivot(spark, d).select("iri", "populationtotal", "birthdate"), vecs)


# ---------------------------------------------------------------- text, triples, logs


def iri_normalize(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "mappingbased_literals").select("s").distinct()
    return rows.select("s", normalize_iri(F.col("s")).alias("iri"))


def nt_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null and text <> ''")
    rows = docs.select("doc_id", F.concat(F.lit(RES + "d"), F.col("doc_id").cast("string")).alias("s"), F.lit(LABEL).alias("p"), F.col("text").alias("o"), F.lit(False).alias("o_is_iri"), F.lit("en").alias("lang"), F.lit(None).cast("string").alias("datatype"))
    lines = ntriples.format_triples(rows)
    back = ntriples.parse_triples(lines)
    return back.select(F.substring("s", len(RES) + 2, 20).cast("bigint").alias("doc_id"), F.col("o").alias("text"), "lang")


def parsed_lines(spark: SparkSession, d: str) -> DataFrame:
    got = ntriples.parse_triples(table(spark, d, "raw_lines").select("line_id", F.col("line").alias("value")))
    return got.groupBy("p", "o_is_iri").agg(F.count("*").alias("n"), F.count_distinct("s").alias("subjects"))


def _log_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.explode(F.split("text", "\r\n|\r|\n")).alias("value"))


def pageview_log(spark: SparkSession, d: str) -> DataFrame:
    return ntriples.parse_pageviews(_log_lines(spark, d), "kb", ["en"] + TARGET_LANGS, ["desktop", "mobile-web"])


def _english(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entities").select("iri", F.col("entity_id").alias("q"), F.substring("iri", len(RES) + 1, 1 << 20).alias("title")).distinct()


def _sisters(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("iri", F.lower("lang").alias("lang")).filter("lang <> 'en' and iri is not null")
    return docs.join(_english(spark, d), "iri").select("q", "lang", "title").distinct()


def entity_views(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "documents").filter("iri is not null").select(F.lower("lang").alias("lang"), F.substring("iri", len(RES) + 1, 1 << 20).alias("title"), F.coalesce("n_chars", F.lit(0)).alias("views"))
    return ranking.views_per_entity(pages, _english(spark, d), _sisters(spark, d))


def edition_links(spark: SparkSession, d: str) -> DataFrame:
    s = _sisters(spark, d)
    lines = s.select(F.concat(F.lit("<http://www.wikidata.example/entity/Q"), F.col("q").cast("string"), F.lit("> <http://www.w3.org/2002/07/owl#sameAs> <http://"), "lang", F.lit(".kb.example/resource/"), "title", F.lit("> .")).alias("value"))
    return ntriples.parse_edition_links(lines).groupBy("q").agg(F.count_distinct("lang").alias("languages"))


def abox_lines(spark: SparkSession, d: str) -> DataFrame:
    lit = table(spark, d, "mappingbased_literals").filter("s is not null and o is not null").select("s", "p", "o", F.lit(False).alias("o_is_iri"), F.when(F.col("datatype").isNull(), F.coalesce("lang", F.lit("en"))).alias("lang"), "datatype")
    links = _objects(spark, d).select("s", "p", "o", F.lit(True).alias("o_is_iri"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("datatype"))
    return ntriples.format_triples(lit.union(links)).distinct()


def import_lines(spark: SparkSession, d: str) -> DataFrame:
    sub = hierarchy.links(table(spark, d, "hierarchy_parents"))
    inst = table(spark, d, "entities").select("iri", F.explode("types").alias("type")).distinct()
    return ntriples.import_lines(sub, inst, _objects(spark, d).distinct())


def typed_literals(spark: SparkSession, d: str) -> DataFrame:
    kinds = table(spark, d, "attributes").groupBy("p").agg(F.min("coltype").alias("kind"))
    rows = table(spark, d, "mappingbased_literals").filter("o is not null").join(kinds, "p", "left")
    return rows.select(ntriples.literal_datatype(F.col("kind"), F.col("o"), XSD).alias("inferred"), "datatype").groupBy("inferred", "datatype").agg(F.count("*").alias("n"))


def loader_payload(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "entities").filter("iri is not null").withColumn("untitled", F.col("title").isNull())
    rows = enrich.first_of(e, "iri", "untitled", "title", "languages", "abstract", "types", "props", "vector")
    edges = enrich.edges_within(_objects(spark, d).distinct(), rows)
    return ntriples.payload(ntriples.entity_bodies(rows, edges, ONT, LABEL, "entities"), 400)


# ---------------------------------------------------------------- hierarchies and places


def class_levels(spark: SparkSession, d: str) -> DataFrame:
    return graph.levels(hierarchy.links(table(spark, d, "hierarchy_parents"))).select(F.col("c").alias("cls"), F.col("a").alias("ancestor"), "depth")


def class_closure(spark: SparkSession, d: str) -> DataFrame:
    return graph.closure(hierarchy.links(table(spark, d, "hierarchy_parents"))).select(F.col("c").alias("cls"), F.col("a").alias("ancestor"))


def _roots(links: DataFrame) -> DataFrame:
    wide = links.groupBy(F.col("p").alias("root")).agg(F.count("*").alias("n")).filter("n >= 5")
    return wide.select("root", F.sha2("root", 256).alias("bucket"), F.col("root").alias("ord"))


def bucket_assign(spark: SparkSession, d: str) -> DataFrame:
    links = cut(hierarchy.links(table(spark, d, "hierarchy_parents")))
    classes = links.select(F.explode(F.array("c", "p")).alias("cls")).distinct()
    return graph.assign_buckets(classes, graph.levels(links), _roots(links))


def _part_edges(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    leaf = F.concat_ws("/", "p_brand", "p_type")
    edges = p.select(leaf.alias("c"), F.col("p_type").alias("p")).union(p.select("p_type", F.lit("Part")))
    fixed = spark.createDataFrame([("Part", "Thing"), ("Part", "Item"), ("Item", "Part")], "c string, p string")
    return edges.union(fixed).distinct()


def inferred_types(spark: SparkSession, d: str) -> DataFrame:
    inst = table(spark, d, "part").select(F.col("p_partkey").alias("iri"), F.concat_ws("/", "p_brand", "p_type").alias("type"))
    return graph.inferred_types(inst, graph.closure(_part_edges(spark, d)))


def class_extent(spark: SparkSession, d: str) -> DataFrame:
    return inferred_types(spark, d).groupBy("type").agg(F.count("*").alias("members"))


def class_members(spark: SparkSession, d: str) -> DataFrame:
    """The first members of a class whose members have it by inference only."""
    return graph.extent(inferred_types(spark, d), "Item").orderBy("iri").limit(100)


def closure_diff(spark: SparkSession, d: str) -> DataFrame:
    links = cut(hierarchy.links(table(spark, d, "hierarchy_parents")))
    subclass = hierarchy.links(table(spark, d, "hierarchy_parents").filter("via = 'subClassOf'"))
    return graph.two_way_difference(graph.closure(links), graph.closure(subclass)).select(F.col("c").alias("cls"), F.col("a").alias("ancestor"), "side")


def _countries(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "entities").select(F.explode("countries").alias("n")).distinct()
    return c.select(F.concat(F.lit(RES), "n").alias("x"), F.concat(F.lit(RES), "n").alias("place"))


def walk_up(spark: SparkSession, d: str) -> DataFrame:
    return graph.walk(_objects(spark, d), _countries(spark, d), [ONT + p for p in WALK], HOPS)


_RULES = graph.Resolution({
    "People": [graph.Property(ONT + "birthPlace"), graph.Property(ONT + "country")],
    "Organisations": [graph.Property(ONT + "location"), graph.Property(ONT + "founder", ("People",))],
    "Works": [graph.Property(ONT + "author", ("People", "Organisations")), graph.Property(ONT + "country")],
    "Places": [graph.Property(ONT + "isPartOf"), graph.Property(ONT + "country")],
})


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    ents = table(spark, d, "entities").select(F.col("iri").alias("x"), "grp").distinct()
    return graph.resolve(ents, _objects(spark, d).distinct(), walk_up(spark, d), _RULES)


def resolve_ordered(spark: SparkSession, d: str) -> DataFrame:
    return _resolved(spark, d).select("x", F.array_join("places", "|").alias("places"), "via")


def geography_gate(spark: SparkSession, d: str) -> DataFrame:
    ents = table(spark, d, "entities").groupBy(F.col("iri").alias("x")).agg(F.max("languages").alias("editions"))
    target = [r["x"] for r in _countries(spark, d).orderBy("x").limit(8).collect()]
    out = graph.decide(ents, _resolved(spark, d), target, 4)
    return out.select("x", "passes", "reason", F.array_join("places", "|").alias("places"))


def tbox_clean(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "hierarchy_parents").select(hierarchy.full_iri(F.col("cls")).alias("s"), F.col("via").alias("p"), hierarchy.full_iri(F.col("parent")).alias("o")).filter("o is not null").distinct()
    declared = table(spark, d, "hierarchy_classes").select("cls")
    rules = [
        ("undeclared_parent", (F.col("p") == "subClassOf") & ~F.col("o_declared")),
        ("non_ascii", F.col("s").rlike(r"[^\x00-\x7F]") | F.col("o").rlike(r"[^\x00-\x7F]")),
        ("equivalence", F.col("p") == "equivalentClass"),
    ]
    return graph.clean_axioms(t, rules, declared)


def el_split(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "mappingbased_objects").filter("s is not null and o is not null")
    links = o.filter("o_is_iri").select("s", "p", "o")
    blank = o.filter("not o_is_iri and o like '\\\\_:%'").select("s", "p", "o")
    both = links.union(blank).union(blank.select(F.col("o").alias("s"), "p", F.col("s").alias("o")))
    profile = graph.Profile(frozenset({ONT + "genre"}), frozenset({RES + "none"}), frozenset({ONT + "country", ONT + "author"}), ONT + "type")
    return graph.split_profile(both, profile).groupBy("reason").agg(F.count("*").alias("n"))


def tbox_counts(spark: SparkSession, d: str) -> DataFrame:
    links = cut(hierarchy.links(table(spark, d, "hierarchy_parents")))
    one = lambda df, name: df.agg(F.lit(name).alias("what"), F.count("*").alias("n"))
    declared = table(spark, d, "hierarchy_classes").select("cls").distinct()
    nodes = links.select(F.explode(F.array("c", "p")).alias("cls")).distinct()
    return one(declared, "declared").union(one(nodes, "nodes")).union(one(graph.closure(links), "subsumptions"))


# ---------------------------------------------------------------- ranking


def bucket_zscore_rank(spark: SparkSession, d: str) -> DataFrame:
    s = ranking.above_floor(_scored(spark, d), FLOORS)
    return s.select("iri", "bucket", "views", "languages", F.round("score", 6).alias("score"))


def interleave_tiers(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d).select("rank", "iri", "bucket", "tier_min")


def tier_prefix_counts(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d).groupBy("tier_min", "bucket").agg(F.count("*").alias("n"), F.max("rank").alias("last_rank"))


def preflight_demand(spark: SparkSession, d: str) -> DataFrame:
    return ranking.demand(_scored(spark, d), BUCKETS, FLOORS, TIERS[-1])


# ---------------------------------------------------------------- vectors and checks


def _vecs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label")


def knn(spark: SparkSession, d: str) -> DataFrame:
    rows = _vecs(spark, d)
    out = vectors.nearest(rows, rows.filter("id % 100 = 0"), 10)
    return out.select("probe", "id", "place", F.round("score", 4).alias("score"))


def knn_class_scoped(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours among the members of a class that holds several labels: the closure is joined before any product."""
    rows = _vecs(spark, d)
    inst = rows.select(F.col("id").alias("iri"), F.concat(F.lit("label"), "label").alias("type"))
    parity = F.when(F.col("label") % 2 == 1, "odd").otherwise("even")
    edges = rows.select(F.concat(F.lit("label"), "label").alias("c"), parity.alias("p")).union(rows.select(parity, F.lit("any"))).distinct()
    members = graph.extent(graph.inferred_types(inst, graph.closure(edges)), "odd").select(F.col("iri").alias("id"))
    out = vectors.nearest_in_class(rows, members, rows.filter("id % 100 = 0"), 5)
    return out.select("probe", "id", "place", F.round("score", 4).alias("score"))


def vector_checks(spark: SparkSession, d: str) -> DataFrame:
    return vectors.vector_report(table(spark, d, "entities"), "vector", 64)


def embedded_test_vectors(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "entities").select("iri").distinct()
    return vectors.embed(rows, 64).select("iri", F.size("vector").alias("dims"), F.round(vectors.norm(F.col("vector")), 4).alias("norm"))


def token_cost(spark: SparkSession, d: str) -> DataFrame:
    return vectors.embedding_cost(table(spark, d, "entities").filter("title is not null and abstract is not null"), 4.06, 0.02)


def tier_checks(spark: SparkSession, d: str) -> DataFrame:
    return checks.tier_report(_ranked(spark, d).select("iri", "rank", "tier_min"), TIERS)


_ALL = (
    interleave_tiers, candidate_pool, dedup_first, type_counts, edition_languages, monthly_views, redirect_canon, country_distribution, top_titles, edges_in_tier,
    dangling_edges, object_labels, props_pivot, props_struct, wide_entities, iri_normalize, nt_roundtrip, parsed_lines, pageview_log, entity_views, edition_links,
    abox_lines, import_lines, typed_literals, loader_payload, class_levels, class_closure, bucket_assign, inferred_types, class_extent, class_members, closure_diff, walk_up,
    resolve_ordered, geography_gate, tbox_clean, el_split, tbox_counts, bucket_zscore_rank, tier_prefix_counts, preflight_demand, knn, knn_class_scoped,
    vector_checks, embedded_test_vectors, token_cost, tier_checks,
)
QUERIES = {f.__name__: f for f in _ALL}

from terrace.plans.reference_sql import SQL  # noqa: E402, F401
