"""The build as seven stages with Parquet between them, and a command line.

    python -m terrace STAGE|all|cost|gate|oracle|payload --config FILE [--force] [--from STAGE] [--allow-short] [--skip-pageviews]

``oracle --pairs OUTPUT --of hierarchy|extents`` compares with a reasoner's output and ends with 1 if they differ.
``payload`` writes a tier as requests for a loader. ``gate`` lists what forbids a release of the output and ends with 1 if anything does, 2 without output.

A stage is skipped when its stamp matches the configuration and the stamps of the stages before it; a change of the
configuration runs everything it may touch again. Stages compose DataFrames only; the driver sees counts and reports.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import shutil
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.config import Config, load_config
from terrace.functions.text import title_of
from terrace.operators import checks, embedding, enrich, graph, ranking, vectors
from terrace.runtime import clear_cuts, cut
from terrace.sources import ntriples, turtle

STAGES = ("acquire", "candidates", "geography", "rank", "enrich", "emit", "validate")
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
SUBCLASS = "http://www.w3.org/2000/01/rdf-schema#subClassOf"
EQUIVALENT = "http://www.w3.org/2002/07/owl#equivalentClass"
LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
COMMENT = "http://www.w3.org/2000/01/rdf-schema#comment"
SUBPROPERTY = "http://www.w3.org/2000/01/rdf-schema#subPropertyOf"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
# What lies outside the OWL 2 EL profile.
_FORBIDDEN = frozenset(OWL + n for n in (
    "inverseOf", "unionOf", "complementOf", "allValuesFrom", "oneOf", "disjointUnionOf", "cardinality", "minCardinality", "maxCardinality",
    "qualifiedCardinality", "minQualifiedCardinality", "maxQualifiedCardinality", "hasSelf", "hasKey",
))
_FORBIDDEN_TYPES = frozenset(OWL + n + "Property" for n in ("Functional", "InverseFunctional", "Symmetric", "Asymmetric", "Irreflexive"))
EL = graph.Profile(_FORBIDDEN, _FORBIDDEN_TYPES, _FORBIDDEN, RDF_TYPE)
TRIPLES = ("ontology", "types", "objects", "literals", "abstracts", "disambiguations", "redirects")


@dataclass
class Build:
    spark: SparkSession
    cfg: Config
    allow_short: bool = False
    skip_pageviews: bool = False

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(str(self.cfg.work / name))

    def write(self, df: DataFrame, name: str) -> None:
        ntriples.write_parquet(df, str(self.cfg.work / name))


def acquire(b: Build) -> None:
    raw = b.cfg.work / "raw"
    raw.mkdir(parents=True, exist_ok=True)
    for name, url in b.cfg.sources.items():
        path = raw / Path(url).name
        ntriples.fetch(url, str(path), b.cfg.sha256.get(name))
        if name == "ontology":
            b.write(turtle.read_ontology(b.spark, str(path)), name)
            continue
        lines = ntriples.read_lines(b.spark, str(path))
        b.write(ntriples.parse_edition_links(lines) if name == "sameas" else ntriples.parse_triples(lines), name)
    if not b.skip_pageviews:
        months = None
        for url in b.cfg.pageviews:
            path = raw / Path(url).name
            ntriples.fetch(url, str(path))
            one = ntriples.parse_pageviews(ntriples.read_lines(b.spark, str(path)), b.cfg.site, b.cfg.languages, b.cfg.methods or None).withColumn("month", F.lit(path.name))
            months = one if months is None else months.union(one)
        if months is not None:
            b.write(months, "pageviews")


def _hierarchy(b: Build, ontology: DataFrame, equivalent: str | None = None) -> DataFrame:
    return graph.hierarchy_edges(ontology.filter("o_is_iri").select("s", "p", "o"), b.cfg.ontology, SUBCLASS, equivalent)


def _tbox(b: Build) -> DataFrame:
    """The ontology's triples with the cleaning ``rule`` or else the profile's ``reason`` that removes them (both null:
    kept). Parents are held against the declared classes only in an ontology that declares any."""
    cfg, t = b.cfg, b.read("ontology").distinct()
    declared = t.filter((F.col("p") == RDF_TYPE) & (F.col("o") == OWL + "Class")).select(F.col("s").alias("cls"))
    own = lambda c: F.col(c).startswith(cfg.ontology)
    iri, odd = F.col("o_is_iri"), r"[^\x00-\x7F]"
    rules = []
    if declared.limit(1).count():
        rules.append(("subclass_of_non_class", (F.col("p") == SUBCLASS) & iri & own("o") & ~F.col("o_declared")))
    if cfg.drop_non_ascii:
        rules.append(("non_ascii", (own("s") & F.col("s").rlike(odd)) | (iri & own("o") & F.col("o").rlike(odd))))
    if cfg.drop_external:
        outward = F.col("p").isin(EQUIVALENT, OWL + "equivalentProperty", OWL + "sameAs", SUBCLASS, SUBPROPERTY)
        rules.append(("external", outward & iri & ~own("o") & (F.col("o") != OWL + "Thing")))
    rules.append(("foreign_language", F.col("p").isin(LABEL, COMMENT) & ~iri & F.col("lang").isNotNull() & ~F.lower("lang").isin(cfg.label_languages)))
    cleaned = cut(graph.clean_axioms(t, rules, declared))
    split = graph.split_profile(cleaned.filter("rule is null").drop("rule"), EL)
    return cut(split.withColumn("rule", F.lit(None).cast("string")).unionByName(cleaned.filter("rule is not null").withColumn("reason", F.lit(None).cast("string"))))


def _tbox_counts(b: Build, tbox: DataFrame, kept: DataFrame, up: DataFrame) -> dict:
    own = lambda c: F.col(c).startswith(b.cfg.ontology)
    by = lambda c: {r[c]: r["count"] for r in tbox.filter(F.col(c).isNotNull()).groupBy(c).count().collect()}
    declared = kept.filter((F.col("p") == RDF_TYPE) & (F.col("o") == OWL + "Class") & own("s")).select("s").distinct()
    named = kept.filter(F.col("p").isin(SUBCLASS, EQUIVALENT) & F.col("o_is_iri") & own("s") & own("o"))
    return {
        "kept_triples": kept.count(), "cleaned": by("rule"), "removed_by_reason": by("reason"), "classes_declared": declared.count(),
        "hierarchy_nodes": declared.union(named.select(F.explode(F.array("s", "o")))).distinct().count(), "subsumptions": up.filter(~F.col("a").isin(OWL + "Thing", b.cfg.ontology + "Thing")).count(),
    }


def candidates(b: Build) -> None:
    edges = _hierarchy(b, b.read("ontology"))
    roots = b.spark.createDataFrame(b.cfg.roots, "root string, bucket string, ord int")
    classes = edges.select(F.explode(F.array("c", "p")).alias("cls")).union(roots.select("root")).distinct()
    missing = roots.join(classes.select(F.col("cls").alias("root")), "root", "left_anti").limit(1).count()
    if missing:
        raise ValueError("a bucket root is no class")
    level = graph.levels(edges)
    buckets = graph.assign_buckets(classes, level, roots).withColumnRenamed("cls", "type")
    resource = F.col("s").startswith(b.cfg.resource)
    types = b.read("types").filter((F.col("p") == RDF_TYPE) & F.col("o").startswith(b.cfg.ontology) & resource).select(F.col("s").alias("iri"), F.col("o").alias("type"))
    # of several types the deepest class counts
    depth = level.groupBy(F.col("c").alias("type")).agg(F.max("depth").alias("depth"))
    types = types.join(depth, "type", "left").groupBy("iri").agg(F.min_by("type", F.struct(-F.coalesce("depth", F.lit(0)), F.col("type"))).alias("type"))
    texts = b.read("abstracts").filter((F.col("p") == COMMENT) & (F.col("lang") == "en") & resource)
    for prefix in b.cfg.skip_prefixes:
        texts = texts.filter(~F.col("s").startswith(b.cfg.resource + prefix))
    texts = texts.select(F.col("s").alias("iri"), title_of(F.col("s"), b.cfg.resource).alias("title"), F.col("o").alias("abstract"))
    noise = [b.read(n).select(F.col("s").alias("iri")) for n in ("disambiguations", "redirects")]
    out = enrich.candidates(types, texts, noise, buckets, [], b.cfg.min_chars)
    groups = F.coalesce(*[F.when(F.col("bucket") == k, F.lit(g)) for k, g in b.cfg.groups.items()])
    b.write(out.withColumn("grp", groups), "candidates")


def _edges(b: Build) -> DataFrame:
    redirects = b.read("redirects").filter("o_is_iri").select(F.col("s").alias("source"), F.col("o").alias("target"))
    return enrich.canonical_objects(b.read("objects").filter("o_is_iri").select("s", "p", "o"), redirects).distinct()


def geography(b: Build) -> None:
    cfg, spark = b.cfg, b.spark
    cand = b.read("candidates")
    countries = b.read("types").filter((F.col("p") == RDF_TYPE) & (F.col("o") == cfg.country_class)).select(F.col("s").alias("x"))
    universe = countries.union(spark.createDataFrame([(t,) for t in cfg.target], "x string"))
    alias = spark.createDataFrame([], "key string, value string")
    if cfg.country_map:
        alias = ntriples.read_dictionary(spark, cfg.country_map, "iri", "country", cfg.resource)
        universe = universe.union(alias.select("value"))
    known = universe.distinct()
    canonical = known.join(alias.select(F.col("key").alias("x"), "value"), "x", "left").select("x", F.coalesce("value", "x").alias("place"))
    canonical = canonical.union(alias.select("key", "value")).distinct()
    edges = _edges(b)
    places = graph.walk(edges, canonical, cfg.walk, cfg.hops)
    resolved = graph.resolve(cand.select(F.col("iri").alias("x"), "grp"), edges, places, cfg.rules)
    links = b.read("sameas")
    english = links.filter("lang = 'en'").groupBy("q").agg(F.min("title").alias("title"))
    counts = links.groupBy("q").agg(F.count_distinct("lang").alias("languages"), F.count_distinct(F.when(F.col("lang").isin(cfg.languages), F.col("lang"))).alias("target_editions"))
    langs = english.join(counts, "q").select(F.concat(F.lit(cfg.resource), "title").alias("iri"), "q", "title", "languages", "target_editions")
    langs = langs.groupBy("iri").agg(F.max(F.struct("languages", "target_editions", "q", "title")).alias("m")).select("iri", "m.*")
    b.write(langs, "languages")
    ents = cand.select(F.col("iri").alias("x")).join(langs.select(F.col("iri").alias("x"), F.col("target_editions").alias("editions")), "x", "left").fillna(0, ["editions"])
    resolved = cut(resolved)
    b.write(graph.decide(ents, resolved, cfg.target, cfg.min_editions).withColumnRenamed("x", "iri"), "geo")
    away = b.read("geo").filter("not passes").select("iri", "reason").join(cand.select("iri", "bucket"), "iri")
    b.write(away.join(resolved.select(F.col("x").alias("iri"), F.col("places").alias("countries")), "iri", "left").select("iri", "bucket", "reason", "countries"), "geo_rejected")


def rank(b: Build) -> None:
    geo, langs = b.read("geo").filter("passes"), b.read("languages")
    cand = b.read("candidates").join(geo.select("iri"), "iri", "left_semi")
    if b.skip_pageviews or not b.cfg.pageviews:
        views = b.spark.createDataFrame([], "iri string, views bigint")
    else:
        sisters = b.read("sameas").filter(F.col("lang").isin(b.cfg.languages) & (F.col("lang") != "en")).select("q", "lang", "title")
        views = ranking.views_per_entity(b.read("pageviews"), langs.select("iri", "q", "title"), sisters)
    pool = cand.select("iri", "bucket").join(views, "iri", "left").join(langs.select("iri", "languages"), "iri", "left")
    pool = pool.select("iri", "bucket", F.coalesce("views", F.lit(0)).alias("views"), F.coalesce("languages", F.lit(1)).cast("int").alias("languages"))
    scored = ranking.bucket_scores(pool, b.cfg.weights)
    b.write(ranking.demand(scored, b.cfg.buckets, b.cfg.floors, b.cfg.tiers[-1]), "demand")
    scored = cut(ranking.above_floor(scored, b.cfg.floors))
    out = ranking.rank_entities(scored, b.cfg.buckets, b.cfg.tiers, b.allow_short)
    used_up = ranking.interleave(ranking.pool_sizes(scored, b.cfg.buckets), b.cfg.buckets, b.cfg.tiers[-1]).exhausted
    (b.cfg.work / "exhausted.json").write_text(json.dumps(used_up, indent=2) + "\n")
    b.write(out.select("rank", "iri", "bucket", "score", "views", "languages", "tier_min"), "ranked")


def enrich_stage(b: Build) -> None:
    ranked, cfg = b.read("ranked"), b.cfg
    members = ranked.select("iri").join(b.read("candidates").select("iri", "grp"), "iri")
    wide = enrich.pivot_properties(enrich.whitelisted(b.read("literals"), members, cfg.allowed), cfg.literals, ranked)
    edges = cut(enrich.whitelisted(_edges(b).filter("s <> o"), members, cfg.allowed))
    listed = enrich.object_labels(edges, cfg.objects, title_of(F.col("o"), cfg.resource))
    labels = listed.groupBy("iri").pivot("name", sorted(set(cfg.objects.values()))).agg(F.first("labels"))
    b.write(enrich.edges_within(edges, ranked), "edges")
    cand = b.read("candidates").select("iri", "title", "abstract", "grp", F.array("type").alias("types"))
    said = cand.join(ranked.select("iri"), "iri", "left_semi").select("iri", F.concat_ws("\n", "title", "abstract").alias("text"))
    embedded = embedding.embed(said, embedding.provider_of(cfg.provider, cfg.dims), str(cfg.work / "vectors"))
    vecs = embedded.vectors
    (cfg.work / "embedding.json").write_text(json.dumps(embedded.info, sort_keys=True, indent=2) + "\n")
    geo = b.read("geo").select("iri", F.transform(F.coalesce("places", F.array().cast("array<string>")), lambda c: F.substring(c, len(cfg.resource) + 1, 1 << 20)).alias("countries"))
    out = enrich.assemble(ranked, cand, geo, enrich.props_struct(wide, labels), vecs)
    text = F.concat_ws("\n", "title", "abstract").alias("embed_text")
    b.write(out.select("iri", "rank", "tier_min", "title", "abstract", text, "bucket", "grp", "types", "countries", "props", "score", "views", "languages", "vector"), "entities")


def _counts(part: DataFrame, column: str) -> dict:
    return {str(r[column]): r["count"] for r in part.groupBy(column).count().orderBy(F.desc("count"), column).collect()}


def emit(b: Build) -> None:
    """All output goes to a folder beside the last one, which is replaced only when everything is there."""
    cfg, ents, edges = b.cfg, b.read("entities"), b.read("edges")
    out = cfg.out.with_name(cfg.out.name + ".part")
    shutil.rmtree(out, ignore_errors=True)
    tbox = _tbox(b)
    kept = tbox.filter("rule is null and reason is null")
    hierarchy = _hierarchy(b, kept, EQUIVALENT)
    up = graph.closure(hierarchy)
    run = json.loads((cfg.work / "embedding.json").read_text()) if (cfg.work / "embedding.json").is_file() else {"provider": "unknown"}
    digest, tiers = hashlib.sha256(cfg.text.encode()).hexdigest(), []
    for n in cfg.tiers:
        name, part = ranking.tier_name(n), ents.filter(F.col("rank") <= n)
        folder = str(out / name)
        inside = enrich.edges_within(edges, part)
        ntriples.write_parquet(part.orderBy("rank"), f"{folder}/entities")
        ntriples.write_parquet(inside.orderBy("s", "p", "o"), f"{folder}/edges")
        inst = part.select("iri", F.explode("types").alias("type"))
        ntriples.write_parquet(graph.inferred_types(inst, up), f"{folder}/types_inferred")
        triple = lambda s, p, o, iri, lang=None: [F.col(s).alias("s"), p.alias("p"), F.col(o).alias("o"), F.lit(iri).alias("o_is_iri"), F.lit(lang).cast("string").alias("lang"), F.lit(None).cast("string").alias("datatype")]
        abox = inst.select(triple("iri", F.lit(RDF_TYPE), "type", True)).union(part.select(triple("iri", F.lit(LABEL), "title", False, "en"))).union(inside.select(triple("s", F.col("p"), "o", True)))
        if cfg.literals:
            abox = abox.union(ntriples.literal_triples(part, cfg.literals, XSD))
        ntriples.format_triples(abox).orderBy("value").write.mode("overwrite").text(f"{folder}/abox")
        ntriples.import_lines(hierarchy, inst, inside).write.mode("overwrite").text(f"{folder}/import_lines")
        countries = _counts(part.select(F.explode("countries").alias("country")), "country")
        tiers.append({
            "name": name, "count": part.count(), "edges": inside.count(), "buckets": _counts(part, "bucket"), "groups": _counts(part, "grp"), "countries": countries,
            "config_sha256": digest, "embedding_run": run["provider"],
        })
    for name, rows in (("tbox", kept), ("tbox_removed", tbox.filter("reason is not null"))):
        ntriples.format_triples(rows).orderBy("value").coalesce(1).write.mode("overwrite").text(str(out / name))
    ntriples.format_turtle(kept).orderBy("value").coalesce(1).write.mode("overwrite").text(str(out / "tbox_turtle"))
    ntriples.format_rdfxml(kept).coalesce(1).sortWithinPartitions("ord", "value").select("value").write.mode("overwrite").text(str(out / "tbox_rdfxml"))
    files = {str(p.relative_to(out)): {"bytes": p.stat().st_size, "sha256": ntriples.file_digest(p)} for p in sorted(out.rglob("part-*")) if p.is_file()}
    manifest = {"name": cfg.name, "embedder": run["provider"], "embedding": run, "tiers": tiers, "tbox": _tbox_counts(b, tbox, kept, up), "files": files}
    ntriples.write_manifest(str(out / "manifest.json"), manifest)
    listed = "\n".join(f"- {t['name']}: {t['count']} entities, {t['edges']} links" for t in tiers)
    (out / "README.md").write_text(f"---\nlicense: {cfg.licence}\n---\n\n# {cfg.name}\n\n{listed}\n\nEach tier holds the smaller ones.\n")
    (out / "ATTRIBUTION.md").write_text(cfg.attribution or "Made from the sources:\n\n" + "".join(f"- {k}: {Path(v).name}\n" for k, v in sorted(cfg.sources.items())))
    shutil.rmtree(cfg.out, ignore_errors=True)
    out.rename(cfg.out)


def validate(b: Build) -> bool:
    """Hard checks on the written tiers, which decide, and notes, which do not; both go to the report."""
    cfg = b.cfg
    at = lambda n, what: b.spark.read.parquet(str(cfg.out / ranking.tier_name(n) / what))
    tier_of = {n: at(n, "entities") for n in cfg.tiers}
    say = lambda tier, check, passed: {"tier": tier, "check": check, "passed": bool(passed)}
    rows = [r.asDict() for r in checks.tier_report(b.read("ranked"), cfg.tiers).orderBy("tier", "check").collect()]
    every = None
    for n, e in tier_of.items():
        one = e.select(F.lit(n).alias("tier"), "iri", "abstract", "types", "vector")
        every = one if every is None else every.unionByName(one)
    manifest = json.loads((cfg.out / "manifest.json").read_text())
    tbox = cut(ntriples.parse_triples(ntriples.read_lines(b.spark, str(cfg.out / "tbox"))))
    declared = tbox.filter((F.col("p") == RDF_TYPE) & (F.col("o") == OWL + "Class")).select(F.col("s").alias("cls")).distinct()
    rows += [r.asDict() for r in checks.entity_report(every, declared, cfg.dims).orderBy("tier", "check").collect()]
    for n, e in tier_of.items():
        edges = at(n, "edges")
        rows.append(say(n, "edges_inside", enrich.edges_within(edges, e).count() == edges.count()))
    # counts quoted in the manifest are taken again from the written axioms
    again = _tbox_counts(b, tbox.withColumns({"rule": F.lit(None).cast("string"), "reason": F.lit(None).cast("string")}), tbox, graph.closure(_hierarchy(b, tbox, EQUIVALENT)))
    same = all(again[k] == manifest["tbox"][k] for k in ("classes_declared", "hierarchy_nodes", "subsumptions"))
    rows.append(say(cfg.tiers[-1], "tbox_counts", same))
    rows.append(say(cfg.tiers[-1], "tbox_nodes", again["hierarchy_nodes"] >= again["classes_declared"]))
    rows.append(say(cfg.tiers[-1], "digests", all((cfg.out / f).is_file() and ntriples.file_digest(cfg.out / f) == want["sha256"] for f, want in manifest["files"].items())))
    for small, large in zip(cfg.tiers, cfg.tiers[1:]):
        prefix = tier_of[large].filter(F.col("rank") <= small).select("iri", "rank")
        rows.append(say(large, f"prefix_{small}", not graph.two_way_difference(tier_of[small].select("iri", "rank"), prefix).limit(1).count()))
        rows.append(say(large, f"vectors_{small}", checks.same_vectors(tier_of[small], tier_of[large])))
    if b.allow_short:
        rows = [r for r in rows if r["check"] != "full"]
    (cfg.out / "report.json").write_text(json.dumps(rows, sort_keys=True, indent=2) + "\n")
    (cfg.out / "notes.json").write_text(json.dumps(_notes(b, tier_of), sort_keys=True, indent=2) + "\n")
    return all(r["passed"] for r in rows)


def _notes(b: Build, tier_of: dict[int, DataFrame]) -> dict:
    """Shares by bucket that are off, leading countries, best titles per bucket, and seeded samples to look at."""
    cfg, top = b.cfg, tier_of[b.cfg.tiers[-1]]
    shares = {x.name: x.share for x in cfg.buckets}
    off = {n: [r["bucket"] for r in checks.bucket_shares(e, shares, cfg.share_tolerance, n).filter("not near").orderBy("bucket").collect()] for n, e in tier_of.items()}
    countries = {n: [tuple(r) for r in e.select(F.explode("countries").alias("c")).groupBy("c").count().orderBy(F.desc("count"), "c").limit(12).collect()] for n, e in tier_of.items()}
    heads = graph.top_per_group(top.select("bucket", "title", "rank"), "bucket", [F.col("rank")], 20).groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("rank", "title"))).alias("t"))
    sample = lambda df, n: df.orderBy(F.xxhash64("iri", F.lit(0)), "iri").limit(n)
    tail = top.filter(F.col("rank") > max(0, cfg.tiers[-1] - 10_000))
    return {
        "shares_off": off, "countries": countries, "heads": {r["bucket"]: [x["title"] for x in r["t"]] for r in heads.collect()},
        "tail": [r["title"] for r in sample(tail, 50).collect()], "countries_of": [[r["title"], r["countries"]] for r in sample(top, 200).collect()],
    }


def cost(b: Build) -> dict:
    return vectors.embedding_cost(b.read("candidates"), b.cfg.chars_per_token, b.cfg.price).first().asDict()


def oracle(b: Build, what: str, pairs: str, tier: int) -> dict:
    """Compare what a reasoner wrote (two columns parted by a tab) with this build: ``hierarchy`` with the closure of the
    written axioms, ``extents`` with a tier's inferred types. Counts per side and three examples each."""
    columns = F.split("value", "\t")
    theirs = b.spark.read.text(pairs).filter("trim(value) <> ''").select(columns[0].alias("a"), columns[1].alias("b")).distinct()
    if what == "hierarchy":
        tbox = ntriples.parse_triples(ntriples.read_lines(b.spark, str(b.cfg.out / "tbox")))
        up = graph.closure(_hierarchy(b, tbox, EQUIVALENT))
        ours = up.filter(~F.col("a").isin(OWL + "Thing", b.cfg.ontology + "Thing")).select(F.col("c").alias("a"), F.col("a").alias("b"))
    else:
        inferred = b.spark.read.parquet(str(b.cfg.out / ranking.tier_name(tier) / "types_inferred"))
        ours = inferred.select(F.col("iri").alias("a"), F.col("type").alias("b")).distinct()
    sides = cut(graph.two_way_difference(ours, theirs))
    out: dict = {"ours": ours.count(), "theirs": theirs.count()}
    for side, name in (("left", "only_ours"), ("right", "only_theirs")):
        mine = sides.filter(F.col("side") == side)
        out[name] = {"n": mine.count(), "examples": [[r["a"], r["b"]] for r in mine.orderBy("a", "b").limit(3).collect()]}
    return out


def payload(b: Build, tier: int, per_request: int = 400) -> str:
    """Write the loader's requests of a tier, one per line; returns their folder."""
    folder = b.cfg.out / ranking.tier_name(tier)
    read = lambda what: b.spark.read.parquet(str(folder / what))
    bodies = ntriples.entity_bodies(read("entities"), read("edges"), b.cfg.ontology, LABEL, "entities")
    ntriples.requests(ntriples.payload(bodies, per_request)).write.mode("overwrite").text(str(folder / "requests"))
    return str(folder / "requests")


RUN = {"acquire": acquire, "candidates": candidates, "geography": geography, "rank": rank, "enrich": enrich_stage, "emit": emit, "validate": validate}


def _stamp(b: Build, stage: str) -> str:
    before = "".join((b.cfg.work / f".{s}.stamp").read_text() for s in STAGES[: STAGES.index(stage)] if (b.cfg.work / f".{s}.stamp").is_file())
    return hashlib.sha256(f"{b.cfg.text}|{b.allow_short}|{b.skip_pageviews}|{before}".encode()).hexdigest()


def run(b: Build, stages: tuple[str, ...] = STAGES, force: bool = False) -> bool:
    """Run the stages in order; False when validation fails."""
    b.cfg.work.mkdir(parents=True, exist_ok=True)
    ok = True
    for stage in stages:
        mark = b.cfg.work / f".{stage}.stamp"
        if not force and stage != "validate" and mark.is_file() and mark.read_text() == _stamp(b, stage):
            continue
        result = RUN[stage](b)
        clear_cuts(b.spark)  # stages hand on what they have written, no frames
        ok = ok and result is not False
        mark.write_text(_stamp(b, stage))
    return ok


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="terrace")
    p.add_argument("stage", choices=[*STAGES, "all", "cost", "gate", "oracle", "payload"])
    p.add_argument("--config", required=True)
    p.add_argument("--force", action="store_true")
    p.add_argument("--from", dest="start", choices=STAGES)
    p.add_argument("--allow-short", action="store_true")
    p.add_argument("--skip-pageviews", action="store_true")
    p.add_argument("--pairs", help="oracle: the reasoner's output")
    p.add_argument("--of", choices=("hierarchy", "extents"), default="extents")
    p.add_argument("--tier", type=int, help="oracle, payload: the tier, the largest if not given")
    a = p.parse_args(argv)
    if a.stage == "gate":
        out = load_config(a.config).out
        if not out.is_dir():
            return 2
        problems = checks.release_gate(str(out))
        print(json.dumps(problems, sort_keys=True))
        return int(bool(problems))
    spark = SparkSession.builder.appName("terrace").getOrCreate()
    b = Build(spark, load_config(a.config), a.allow_short, a.skip_pageviews)
    if a.stage == "cost":
        print(json.dumps(cost(b), sort_keys=True))
        return 0
    if a.stage == "payload":
        print(payload(b, a.tier or b.cfg.tiers[-1]))
        return 0
    if a.stage == "oracle":
        if not a.pairs:
            p.error("oracle needs --pairs")
        found = oracle(b, a.of, a.pairs, a.tier or b.cfg.tiers[-1])
        print(json.dumps(found, sort_keys=True))
        return int(bool(found["only_ours"]["n"] or found["only_theirs"]["n"]))
    stages = STAGES[STAGES.index(a.start or STAGES[0]) :] if a.stage == "all" else (a.stage,)
    return 0 if run(b, stages, a.force or a.stage != "all") else 1
