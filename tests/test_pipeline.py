"""All stages over a small synthetic knowledge base with a known outcome for each entity."""

import bz2
import json

import pytest

from terrace.config import load_config
from terrace.operators import checks
from terrace.pipeline import COMMENT, Build, cost, run

R, O = "http://kb.example/resource/", "http://kb.example/ontology/"
TYPE, SUB = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://www.w3.org/2000/01/rdf-schema#subClassOf"

CONFIG = """
[dataset]
name = "small"
tiers = [4, 6, 8]
[namespaces]
resource = "http://kb.example/resource/"
ontology = "http://kb.example/ontology/"
[sources]
ontology = "ontology.nt"
types = "types.nt.bz2"
objects = "objects.nt"
literals = "literals.nt"
abstracts = "abstracts.nt"
disambiguations = "disambiguations.nt"
redirects = "redirects.nt"
sameas = "sameas.nt"
[pageviews]
files = ["views-1.txt", "views-2.txt"]
site = "kb"
languages = ["en", "de", "fr", "nl", "es"]
methods = ["desktop", "mobile-web"]
[candidates]
min_chars = 20
skip_prefixes = ["List_of"]
[[buckets]]
name = "Poet"
group = "People"
share = 2.0
roots = ["Poet"]
[[buckets]]
name = "Town"
group = "Places"
share = 1.0
roots = ["Town"]
[geography]
target = ["Landia", "Ostia"]
country_map = "countries.csv"
walk = ["country", "isPartOf"]
hops = 3
min_editions = 4
[[geography.resolution.People]]
property = "nationality"
[[geography.resolution.People]]
property = "birthPlace"
[[geography.resolution.Places]]
property = "country"
[[geography.resolution.Places]]
property = "isPartOf"
[ranking.weights]
views = 0.6
languages = 0.4
[ranking.floors]
views = 10
languages = 2
[[properties.literals]]
property = "born"
column = "born"
type = "int"
groups = ["People"]
[[properties.objects]]
property = "birthPlace"
column = "birthplace"
"""


def triple(s, p, o):
    o = f"<{o}>" if o.startswith("http") else o
    return f"<{s}> <{p}> {o} .\n"


@pytest.fixture(scope="module")
def build(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("kb")
    poets, towns = [f"Poet_{i}" for i in range(8)], [f"Town_{i}" for i in range(4)]
    onto = [triple(O + "Poet", SUB, O + "Person"), triple(O + "OdePoet", SUB, O + "Poet"), triple(O + "Town", SUB, O + "Place")]
    types, objs, lits, texts, same = [], [], [], [], []
    views = {1: [], 2: []}
    for i, name in enumerate(poets + towns):
        poet = name in poets
        types.append(triple(R + name, TYPE, O + ("OdePoet" if poet and i % 2 else "Poet" if poet else "Town")))
        texts.append(triple(R + name, COMMENT, f'"{name} is a well known entity of this base."@en'))
        for lang in ("", "de.", "fr.", "nl.")[: 2 + i % 3]:
            same.append(f"<http://www.wikidata.example/entity/Q{i}> <http://www.w3.org/2002/07/owl#sameAs> <http://{lang}kb.example/resource/{name}> .\n")
        for m in views:
            views[m] += [f"en.kb {name} {i} desktop {100 * (i + 1)} A1\n", f"de.kb {name} {i} mobile-web 5 A1\n", f"xx.kb {name} {i} desktop 9999 A1\n", f"en.kb {name} {i} app 9999 A1\n"]
        if poet:
            lits.append(triple(R + name, O + "born", f'"{1900 + i}.0"^^<http://schema.example/xsd#integer>'))
            objs.append(triple(R + name, O + "birthPlace", R + f"Town_{i % 4}"))
    texts += [triple(R + "Poet_0", COMMENT, '"A B Deutsch, das vorne stünde, ist kein Text."@de'), triple(R + "Poet_0", O + "note", '"A A note that is no comment at all."@en')]
    lits.append(triple(R + "Town_0", O + "born", '"1700"^^<http://schema.example/xsd#integer>'))
    objs.append(triple(R + "Poet_1", O + "unlisted", R + "Town_1"))
    objs += [triple(R + "Town_0", O + "country", R + "Landia"), triple(R + "Town_1", O + "country", R + "Old_Ostia"), triple(R + "Town_2", O + "isPartOf", R + "Shire")]
    objs += [triple(R + "Shire", O + "country", R + "Land_alias"), triple(R + "Town_3", O + "country", R + "Farland")]
    types += [triple(R + c, TYPE, O + "Country") for c in ("Landia", "Ostia", "Farland")]
    types += [triple(R + "List_of_poets", TYPE, O + "Poet"), triple(R + "Poet", TYPE, O + "Poet"), triple(R + "Mute", TYPE, O + "Poet")]
    texts += [triple(R + "List_of_poets", COMMENT, '"A list of all the poets there are."@en'), triple(R + "Poet", COMMENT, '"Poet may refer to several things."@en'), triple(R + "Mute", COMMENT, '"Short."@en')]
    write = lambda name, lines: (d / name).write_text("# header\n" + "".join(lines) + "broken line\n")
    write("ontology.nt", onto)
    (d / "types.nt.bz2").write_bytes(bz2.compress(("# c\n" + "".join(types)).encode()))
    write("objects.nt", objs)
    write("literals.nt", lits)
    write("abstracts.nt", texts)
    write("disambiguations.nt", [triple(R + "Poet", O + "disambiguates", R + "Poet_1")])
    write("redirects.nt", [triple(R + "Land_alias", O + "redirect", R + "Landia")])
    write("sameas.nt", same)
    for m, lines in views.items():
        (d / f"views-{m}.txt").write_text("".join(lines) + "en.kb ragged\n")
    (d / "countries.csv").write_text("iri,country,note\nOld_Ostia,Ostia,historic\n")
    (d / "c.toml").write_text(CONFIG)
    b = Build(spark, load_config(str(d / "c.toml")), allow_short=True)
    assert run(b), (b.cfg.out / "report.json").read_text()
    return b


def test_candidates_leave_noise_out(build):
    got = {r["iri"].removeprefix(R) for r in build.read("candidates").collect()}
    assert got == {f"Poet_{i}" for i in range(8)} | {f"Town_{i}" for i in range(4)}


def test_geography(build):
    got = {r["iri"].removeprefix(R): (r["passes"], r["reason"].removeprefix(O), r["places"]) for r in build.read("geo").collect()}
    assert got["Poet_0"] == (True, "birthPlace", [R + "Landia"])
    assert got["Poet_1"] == (True, "birthPlace", [R + "Ostia"])
    assert got["Poet_2"] == (True, "birthPlace", [R + "Landia"])
    assert got["Poet_3"] == (False, "non_target_country", [])
    assert got["Town_3"][0] is False


def test_ranking_and_tiers(build):
    ranked = {r["rank"]: r for r in build.read("ranked").collect()}
    assert sorted(ranked) == list(range(1, len(ranked) + 1))
    assert [ranked[k]["bucket"] for k in (1, 2, 3)] == ["Poet", "Town", "Poet"]
    assert all(r["tier_min"] == (4 if k <= 4 else 6 if k <= 6 else 8) for k, r in ranked.items())
    views = {r["iri"]: r["views"] for r in ranked.values()}
    assert views[R + "Poet_5"] == 2 * 600 + 2 * 5


def test_wide_rows_and_outputs(build):
    e = {r["iri"]: r for r in build.read("entities").collect()}
    one = e[R + "Poet_1"]
    assert one["props"]["born"] == 1901 and one["props"]["birthplace_label"] == ["Town 1"] and len(one["vector"]) == 64
    assert one["countries"] == ["Ostia"]
    manifest = json.loads((build.cfg.out / "manifest.json").read_text())
    assert [t["name"] for t in manifest["tiers"]] == ["t4", "t6", "t8"]
    inferred = {(r["iri"], r["type"]) for r in build.spark.read.parquet(str(build.cfg.out / "t8/types_inferred")).collect()}
    assert (R + "Poet_1", O + "Person") in inferred
    assert cost(build)["entities"] == 12
    texts = {r["iri"]: r["abstract"] for r in build.read("candidates").collect()}
    assert texts[R + "Poet_0"].startswith("Poet_0 is") and all(r["props"] is None or r["props"]["born"] is None for i, r in e.items() if "Town" in i)
    assert {r["p"] for r in build.read("edges").collect()} == {O + "birthPlace"}
    assert manifest["tiers"][0]["groups"]["People"] > manifest["tiers"][0]["groups"]["Places"] and manifest["tiers"][2]["countries"]["Landia"] > 1


def test_reports(build):
    away = {r["iri"].removeprefix(R): (r["bucket"], r["reason"], r["countries"]) for r in build.read("geo_rejected").collect()}
    assert away["Poet_3"] == ("Poet", "non_target_country", [R + "Farland"])
    report = {(r["tier"], r["check"]) for r in json.loads((build.cfg.out / "report.json").read_text())}
    each = {"unique", "conforming", "dense", "within", "abstracts", "types", "dims", "unit_vectors", "declared_types", "edges_inside"}
    assert {(n, c) for n in (4, 6, 8) for c in each} <= report and {(8, "digests"), (8, "tbox_counts"), (8, "tbox_nodes"), (6, "prefix_4"), (6, "vectors_4"), (8, "vectors_6")} <= report
    notes = json.loads((build.cfg.out / "notes.json").read_text())
    assert notes["heads"]["Poet"] and len(notes["countries_of"]) == len(build.read("entities").collect())
    assert "exhausted.json" in {p.name for p in build.cfg.work.iterdir()}


def test_requests(build):
    from terrace.pipeline import payload

    folder = payload(build, 8, 3)
    lines = [json.loads(r["value"]) for r in build.spark.read.text(folder).collect()]
    n = len(build.read("entities").collect())
    assert sorted(map(len, lines)) == sorted([3] * (n // 3) + [n % 3] * (n % 3 > 0)) and {x["iri"] for rows in lines for x in rows} == {r["iri"] for r in build.read("entities").collect()}


def test_oracle(build, tmp_path):
    from terrace.pipeline import oracle

    inferred = {(r["iri"], r["type"]) for r in build.spark.read.parquet(str(build.cfg.out / "t4/types_inferred")).collect()}
    pairs = tmp_path / "pairs"
    pairs.write_text("".join(f"{i}\t{t}\n" for i, t in sorted(inferred)) + "\n")
    same = oracle(build, "extents", str(pairs), 4)
    assert same["only_ours"]["n"] == same["only_theirs"]["n"] == 0 and same["ours"] == len(inferred)
    pairs.write_text("".join(f"{i}\t{t}\n" for i, t in sorted(inferred)[1:]) + "x\ty\n")
    odd = oracle(build, "extents", str(pairs), 4)
    assert odd["only_ours"] == {"n": 1, "examples": [list(min(inferred))]} and odd["only_theirs"] == {"n": 1, "examples": [["x", "y"]]}
    pairs.write_text(f"{O}Poet\t{O}Person\n{O}OdePoet\t{O}Poet\n{O}OdePoet\t{O}Person\n{O}Town\t{O}Place\n")
    up = oracle(build, "hierarchy", str(pairs), 4)
    assert up["only_ours"]["n"] == up["only_theirs"]["n"] == 0


class Service:
    """A made-up provider that notes what it is asked and fails at first."""

    def __init__(self, folder, name="service-1", dims=8):
        self.folder, self.name, self.dims = str(folder), name, dims

    def embed(self, keys, texts):
        import pathlib
        import uuid

        import numpy as np

        here = pathlib.Path(self.folder)
        flag = here / f"failed-{keys[0].rpartition('/')[2]}"
        if not flag.exists():
            flag.touch()
            raise ConnectionError("try again")
        for k in keys:
            (here / f"asked-{uuid.uuid4().hex}").write_text(k)
        return [np.arange(1.0, self.dims + 1) * (len(t) + 1) for t in texts], sum(len(t) for t in texts)


def test_embedding_is_taken_up_again(spark, tmp_path):
    from terrace.operators import embedding, vectors

    rows = [(f"http://a/{i}", f"text {i}" if i % 5 else None) for i in range(40)]
    frame = lambda data: spark.createDataFrame(data, "iri string, text string")
    asked = lambda: len(list(tmp_path.glob("asked-*")))
    run = lambda data, **k: embedding.embed(frame(data), Service(tmp_path, **k), str(tmp_path / "v"), wave_rows=15, batch=7, wait=0.0)
    first = run(rows[:30] + rows[:3])
    assert asked() == 30 and first.info["asked"] == 30 and first.info["waves"] == 2 and first.info["tokens"] == sum(len(t or "") for _, t in rows[:30])
    more = run(rows)
    assert asked() == 40 and more.info["asked"] == 10 and more.info["count"] == 40
    changed = run([(rows[0][0], "other"), *rows[1:]])
    assert asked() == 41 and changed.info["asked"] == 1
    assert run(rows, name="service-2").info["asked"] == 40
    got = {r["iri"]: r["vector"] for r in more.vectors.collect()}
    assert len(got) == 40 and all(abs(sum(x * x for x in v) - 1) < 1e-6 for v in got.values())
    with pytest.raises(Exception, match="shape"):
        bad = Service(tmp_path, name="bad")
        bad.dims = 8
        bad.embed = lambda keys, texts: ([[1.0]] * len(keys), 0)
        embedding.embed(frame(rows[:2]), bad, str(tmp_path / "w"), tries=1).vectors.collect()
    with pytest.raises(ValueError):
        embedding.provider_of("nowhere", 8)
    import hashlib

    import numpy as np

    seed = int.from_bytes(hashlib.sha256(b"http://a/1").digest()[:8], "little")
    want = np.random.Generator(np.random.PCG64(seed)).standard_normal(8).astype(np.float32)
    assert np.allclose(vectors.seeded_vector("http://a/1", 8), want / np.linalg.norm(want))
    assert embedding.embed(frame([]), embedding.Seeded(8), str(tmp_path / "e")).info["count"] == 0


def test_broken_tiers_are_found(build, spark):
    from pyspark.sql import functions as F

    ents = build.read("entities").withColumn("tier", F.lit(8))
    declared = spark.createDataFrame([(O + "Poet",), (O + "OdePoet",), (O + "Town",)], "cls string")
    verdict = lambda df: {r["check"] for r in checks.entity_report(df, declared, 64).collect() if not r["passed"]}
    assert verdict(ents) == set()
    odd = F.col("rank") == 1
    assert verdict(ents.withColumn("abstract", F.when(odd, "").otherwise(F.col("abstract")))) == {"abstracts"}
    assert verdict(ents.withColumn("types", F.when(odd, F.array(F.lit("x"))).otherwise(F.col("types")))) == {"declared_types"}
    assert verdict(ents.withColumn("types", F.when(odd, F.array().cast("array<string>")).otherwise(F.col("types")))) == {"types"}
    twice = F.transform("vector", lambda x: x * F.when(odd, 2).otherwise(1).cast("float"))
    assert verdict(ents.withColumn("vector", twice)) == {"unit_vectors"} and not checks.same_vectors(ents, ents.withColumn("vector", twice)) and checks.same_vectors(ents, ents)
    ranked = build.read("ranked").select("iri", "rank", "tier_min")
    failed = lambda df: {(r["tier"], r["check"]) for r in checks.tier_report(df, [4, 6]).collect() if not r["passed"]}
    ranked = ranked.filter("rank <= 6")
    assert failed(ranked) == set()
    assert failed(ranked.withColumn("rank", F.when(F.col("rank") == 4, 6).otherwise(F.col("rank")))) == {(4, "full"), (6, "dense")}
    assert failed(ranked.withColumn("iri", F.when(odd, F.lit("a b")).otherwise(F.col("iri")))) == {(4, "conforming"), (6, "conforming")}
    assert (6, "holds_4") in failed(ranked.withColumn("rank", F.when(odd, 9).otherwise(F.col("rank"))))


def test_stages_are_skipped_when_fresh_and_gate_refuses_test_vectors(build):
    before = (build.cfg.work / "ranked").stat().st_mtime_ns
    assert run(build)
    assert (build.cfg.work / "ranked").stat().st_mtime_ns == before
    assert "embedder" in {p["check"] for p in checks.release_gate(str(build.cfg.out))}


def test_literals_and_whole_tbox(build, spark, tmp_path):
    from dataclasses import replace

    from pyspark.sql import Row

    from terrace.pipeline import LABEL, OWL, XSD, emit
    from terrace.sources import ntriples

    abox = {r["value"] for r in spark.read.text(str(build.cfg.out / "t8/abox")).collect()}
    assert f'<{R}Poet_1> <{O}born> "1901"^^<{XSD}integer> .' in abox
    names = {O + k: (k, "float" if k == "area" else "string") for k in ("area", "day", "year", "motto")}
    props = [Row(area=1e7, day="1901-02-03", year="1901", motto='a "b"'), Row(area=1e-4, day=None, year=None, motto=None), None]
    ents = spark.createDataFrame([(R + str(i), p) for i, p in enumerate(props)], "iri string, props struct<area double, day string, year string, motto string>")
    got = {r["value"].removesuffix(" .").split("/ontology/")[1] for r in ntriples.format_triples(ntriples.literal_triples(ents, names, XSD)).collect()}
    assert got == {f'area> "10000000.0"^^<{XSD}double>', f'area> "0.0001"^^<{XSD}double>', f'day> "1901-02-03"^^<{XSD}date>', f'year> "1901"^^<{XSD}gYear>', 'motto> "a \\"b\\""'}

    keep = [triple(O + c, TYPE, OWL + "Class") for c in ("Poet", "OdePoet", "Person", "Town", "Place")]
    keep += [triple(O + "Poet", SUB, O + "Person"), triple(O + "OdePoet", SUB, O + "Poet"), triple(O + "Town", SUB, O + "Place"), triple(O + "Poet", LABEL, '"poet"@en'), triple(O + "Place", OWL + "equivalentClass", O + "Site"), triple(O + "Person", SUB, OWL + "Thing")]
    cleaned = [triple(O + "Poet", SUB, O + "wrote"), triple(O + "Poet", OWL + "equivalentClass", "http://other.example/Poet"), triple(O + "Poet", LABEL, '"Dichter"@de'), triple(O + "شاعر", TYPE, OWL + "Class")]
    removed = [triple(O + "born", TYPE, OWL + "FunctionalProperty"), "_:u <" + OWL + "unionOf> _:l .\n", f"<{O}Town> <{SUB}> _:u .\n"]
    b = Build(spark, replace(build.cfg, work=tmp_path / "work", out=tmp_path / "out", tiers=[4]))
    for name in ("entities", "edges"):
        b.write(build.read(name), name)
    b.write(ntriples.parse_triples(spark.createDataFrame([(x.strip(),) for x in keep + cleaned + removed], "value string")), "ontology")
    emit(b)
    lines = lambda name: {r["value"] for r in spark.read.text(str(b.cfg.out / name)).collect()}
    assert lines("tbox") == {x.strip() for x in keep} and lines("tbox_removed") == {x.strip() for x in removed}
    counts = json.loads((b.cfg.out / "manifest.json").read_text())["tbox"]
    assert counts["cleaned"] == {"subclass_of_non_class": 1, "external": 1, "foreign_language": 1, "non_ascii": 1}
    assert (counts["kept_triples"], sum(counts["removed_by_reason"].values()), counts["classes_declared"], counts["hierarchy_nodes"], counts["subsumptions"]) == (11, 3, 5, 6, 7)
    inferred = {r["type"] for r in spark.read.parquet(str(b.cfg.out / "t4/types_inferred")).collect()}
    assert O + "Person" in inferred and O + "wrote" not in inferred


def test_bad_config(tmp_path):
    (tmp_path / "c.toml").write_text(CONFIG.replace("[4, 6, 8]", "[4, 4, 8]"))
    with pytest.raises(ValueError):
        load_config(str(tmp_path / "c.toml"))


def test_gate_breaks_one_thing_at_a_time(tmp_path):
    import hashlib

    data = b"x"
    good = {"embedder": "service", "tiers": [{"name": "t4", "count": 4}, {"name": "t10", "count": 10}], "files": {"a": {"bytes": 1, "sha256": hashlib.sha256(data).hexdigest()}}}

    card = "---\nlicense: x\n---\n"

    def gate(manifest=good, report='[{"check": "full", "passed": true}]', content=data, card=card, attribution="x"):
        for name, text in (("README.md", card), ("ATTRIBUTION.md", attribution)):
            (tmp_path / name).unlink(missing_ok=True)
            if text is not None:
                (tmp_path / name).write_text(text)
        (tmp_path / "a").write_bytes(content)
        (tmp_path / "manifest.json").write_text(json.dumps(manifest))
        (tmp_path / "report.json").write_text(report)
        return {p["check"] for p in checks.release_gate(str(tmp_path))}

    assert gate() == set()
    assert gate(good | {"embedder": "seeded"}) == {"embedder"}
    assert gate(report='[{"check": "full", "passed": false}]') == {"report"}
    assert gate(content=b"y") == {"files"} and gate(content=b"xy") == {"files"}
    assert gate(good | {"tiers": [{"name": "t4", "count": 10}, {"name": "t10", "count": 4}]}) == {"tiers"}
    assert gate(good | {"files": {}}) == {"files"} and gate(card=None) == {"card"} and gate(card="# no front matter") == {"card"} and gate(attribution=None) == {"attribution"}
    for key in ("config_sha256", "embedding_run"):
        tiers = [t | {key: str(i)} for i, t in enumerate(good["tiers"])]
        assert gate(good | {"tiers": tiers}) == {key}
