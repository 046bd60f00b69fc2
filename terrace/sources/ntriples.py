"""Line-oriented sources and sinks: N-Triples, edition links, pageview logs, dictionaries, import files."""

from __future__ import annotations

import hashlib
import json
import shutil
import time
from pathlib import Path
from urllib.error import HTTPError
from urllib.parse import urlparse
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from terrace.functions.text import escape_literal, normalize_if_needed, normalize_title, unescape_literal
from terrace.runtime import cut

# Hosts that are no language editions.
OTHER_HOSTS = ("commons", "wikidata", "species", "meta", "global", "wikimedia")
_TRIPLE = r'(?s)^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(<[^>]*>|_:\S+|"(.*)"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?)\s*\.\s*\z'


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the lines of plain, gzip or bz2 text, invalid UTF-8 replaced."""
    return spark.read.text(path).select(F.make_valid_utf8("value").alias("value"))


def parse_triples(lines: DataFrame, value: str = "value") -> DataFrame:
    """``s, p, o, o_is_iri, lang, datatype``: comments, blank and unreadable lines dropped, escapes decoded, IRIs
    normalised where they need it, hosts in capitals included."""
    line = F.col(value)
    got = lambda n: F.regexp_extract(line, _TRIPLE, n)
    rows = lines.filter(~line.rlike(r"^\s*(#|\z)") & line.rlike(_TRIPLE))
    fields = rows.select(*[c for c in lines.columns if c != value], got(1).alias("s"), got(2).alias("p"), got(3).alias("o"), got(4).alias("t"), F.nullif(got(5), F.lit("")).alias("lang"), F.nullif(got(6), F.lit("")).alias("datatype"))
    inner = lambda c: F.regexp_replace(c, "^<|>$", "")
    iri = lambda c: normalize_if_needed(unescape_literal(inner(F.col(c))))
    node = lambda c: F.when(F.col(c).startswith("_:"), F.col(c)).otherwise(iri(c))
    literal = F.col("o").startswith('"')
    extra = [c for c in lines.columns if c != value]
    return fields.select(
        *extra, node("s").alias("s"), iri("p").alias("p"), F.when(literal, unescape_literal(F.col("t"))).otherwise(node("o")).alias("o"),
        F.col("o").startswith("<").alias("o_is_iri"), F.when(literal, F.col("lang")).alias("lang"), F.when(literal, F.col("datatype")).alias("datatype"),
    )


def parse_edition_links(lines: DataFrame, value: str = "value") -> DataFrame:
    """``q, lang, title`` of links from items to language editions; no language means English; pages of namespaces
    (a colon in the title) and of hosts that are no editions are left out. Titles with a percent sign are normalised as
    the IRIs of ``parse_triples`` are."""
    shape = r"^<[^>]*/(Q\d+)>\s+<[^>]*sameAs>\s+<https?://(?:([a-z0-9-]+)\.)?[^/>.]+\.[^/>]+/resource/([^>]+)>\s*\.\s*\z"
    line = F.col(value)
    rows = lines.filter(line.rlike(shape)).select(F.regexp_extract(line, shape, 1).alias("q"), F.coalesce(F.nullif(F.regexp_extract(line, shape, 2), F.lit("")), F.lit("en")).alias("lang"), F.regexp_extract(line, shape, 3).alias("title"))
    rows = rows.filter(~F.col("lang").isin(*OTHER_HOSTS) & ~F.col("title").contains(":"))
    return rows.withColumn("title", F.when(F.col("title").contains("%"), normalize_title(F.col("title"))).otherwise(F.col("title")))


def parse_pageviews(lines: DataFrame, suffix: str, langs: list[str] | None = None, methods: list[str] | None = None, value: str = "value") -> DataFrame:
    """``lang, title, views`` of one log: blank-separated, no quoting, rows of other shapes or with bad counts dropped."""
    f = F.split(F.col(value), " ")
    rows = lines.filter(F.col(value).contains(f".{suffix} ")).select(f[0].alias("wiki"), f[1].alias("title"), F.try_element_at(f, F.lit(4)).alias("method"), F.try_element_at(f, F.lit(5)).try_cast("bigint").alias("views"))
    rows = rows.filter(F.col("wiki").endswith(f".{suffix}") & F.col("views").isNotNull())
    rows = rows.withColumn("lang", F.substring_index("wiki", ".", 1))
    if langs:
        rows = rows.filter(F.col("lang").isin(*langs))
    if methods:
        rows = rows.filter(F.col("method").isin(*methods))
    return rows.groupBy("lang", "title").agg(F.sum("views").alias("views"))


def read_dictionary(spark: SparkSession, path: str, key: str, value: str, prefix: str = "") -> DataFrame:
    """``key``, ``value`` of a CSV with header; of repeated keys the last line wins."""
    rows = spark.read.csv(path, header=True).select(F.concat(F.lit(prefix), F.col(key)).alias("key"), F.concat(F.lit(prefix), F.col(value)).alias("value"), F.monotonically_increasing_id().alias("_n"))
    return rows.groupBy("key").agg(F.max_by("value", "_n").alias("value"))


TRIES, LONGEST_WAIT = 5, 60.0


def _download(url: str, part: Path, tries: int, wait: float) -> None:
    """Into ``part``, going on from what is there if the server can; whatever goes wrong on the way is tried again."""
    for k in range(tries):
        have = part.stat().st_size if part.is_file() else 0
        try:
            asked = Request(url, headers={"Range": f"bytes={have}-"} if have else {})
            with urlopen(asked, timeout=60) as got, part.open("ab" if got.status == 206 else "wb") as f:
                due = got.headers.get("Content-Length")
                before = f.tell()
                shutil.copyfileobj(got, f, 1 << 20)
                if due is not None and f.tell() - before != int(due):
                    raise OSError("the connection ended early")
                return
        except HTTPError as e:
            if e.code == 416 and have:  # nothing is left to send
                return
            if e.code < 500 or k + 1 == tries:
                raise
        except OSError:
            if k + 1 == tries:
                raise
        time.sleep(min(LONGEST_WAIT, wait * 2**k))


def fetch(url: str, target: str, sha256: str | None = None, tries: int = TRIES, wait: float = 1.0) -> str:
    """Bring a ``file``, ``http`` or ``https`` source to ``target`` and check its digest; returns the digest. A file that is
    there with the right digest is not brought again; a broken download goes on where it ended."""
    parsed, done = urlparse(url), Path(target)
    if sha256 and done.is_file() and file_digest(done) == sha256:
        return sha256
    part = Path(f"{target}.part")
    if parsed.scheme == "file":
        shutil.copyfile(parsed.path, part)
    elif parsed.scheme in ("http", "https"):
        _download(url, part, tries, wait)
    else:
        raise ValueError(f"cannot fetch {parsed.scheme} sources")
    digest = file_digest(part)
    if sha256 and digest != sha256:
        part.unlink()
        raise ValueError("the digest does not match")
    part.replace(target)
    return digest


# ---------------------------------------------------------------- sinks


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def format_object(o: Column, o_is_iri: Column, lang: Column, datatype: Column) -> Column:
    quoted = F.concat(F.lit('"'), escape_literal(o), F.lit('"'))
    return (
        F.when(o_is_iri, F.concat(F.lit("<"), o, F.lit(">"))).when(o.startswith("_:") & lang.isNull() & datatype.isNull(), o)
        .when(lang.isNotNull(), F.concat(quoted, F.lit("@"), lang)).when(datatype.isNotNull(), F.concat(quoted, F.lit("^^<"), datatype, F.lit(">"))).otherwise(quoted)
    )


def format_triples(df: DataFrame) -> DataFrame:
    """``value``: one N-Triples line per row of s, p, o, o_is_iri, lang, datatype."""
    node = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(F.concat(F.lit("<"), F.col("s"), F.lit(">")))
    obj = format_object(*[F.col(c) for c in ("o", "o_is_iri", "lang", "datatype")])
    return df.select(F.concat(node, F.lit(" <"), F.col("p"), F.lit("> "), obj, F.lit(" .")).alias("value"))


def infer_datatype(value: Column, xsd: str) -> Column:
    """Datatype of a text value by its shape: date, year, or none. Numbers are typed by their column, not by shape."""
    return F.when(value.rlike(r"^-?\d{4}-\d{2}-\d{2}\z"), xsd + "date").when(value.rlike(r"^-?\d{4}\z"), xsd + "gYear")


def literal_datatype(kind: Column, value: Column, xsd: str) -> Column:
    """Datatype of a value by the kind of its column (int, float), text and dates by their shape."""
    return F.when(kind == "int", xsd + "integer").when(kind == "float", xsd + "double").otherwise(infer_datatype(value, xsd))


@F.pandas_udf(StringType())
def double_text(value: pd.Series) -> pd.Series:
    """The shortest text that reads back as the same double."""
    odd = {"inf": "INF", "-inf": "-INF"}
    return value.map(lambda v: odd.get(repr(float(v)), repr(float(v))), na_action="ignore").astype(object)


def literal_triples(entities: DataFrame, names: dict[str, tuple[str, str]], xsd: str) -> DataFrame:
    """``s, p, o, o_is_iri, lang, datatype`` of every non-null literal column of ``props`` (names: predicate -> column,
    kind). A column of several predicates is written under the first."""
    first = {c: (p, k) for p, (c, k) in reversed(names.items())}

    def one(column: str, predicate: str, kind: str) -> Column:
        value = F.col("props")[column]
        text = double_text(value) if kind == "float" else value.cast("string")
        datatype = literal_datatype(F.lit(kind), text, xsd)
        return F.struct(F.lit(predicate).alias("p"), text.alias("o"), datatype.cast("string").alias("datatype"))

    rows = entities.select(F.col("iri").alias("s"), F.explode(F.array(*[one(c, p, k) for c, (p, k) in sorted(first.items())])).alias("t"))
    return rows.filter("t.o is not null").select("s", "t.p", "t.o", F.lit(False).alias("o_is_iri"), F.lit(None).cast("string").alias("lang"), "t.datatype")


def import_lines(subclasses: DataFrame, instances: DataFrame, links: DataFrame) -> DataFrame:
    """``value``: SUBCLASS, INSTANCE and PROPERTY lines for a line importer."""
    return (
        subclasses.select(F.concat_ws(" ", F.lit("SUBCLASS"), "c", "p").alias("value"))
        .union(instances.select(F.concat_ws(" ", F.lit("INSTANCE"), "iri", "type")))
        .union(links.select(F.concat_ws(" ", F.lit("PROPERTY"), "s", "p", "o")))
    )


def entity_bodies(entities: DataFrame, edges: DataFrame, namespace: str, label: str, collection: str) -> DataFrame:
    """``iri``, ``body``: each entity as a JSON row for a loader: classes, label, abstract, literal and object properties
    and the vector rounded to 6 places. Null and NaN values have no property.

    ``entities``: iri, title, abstract, types, props, vector, one row per iri; ``edges``: s, p, o.
    """

    def prop(name: Column, kind: str, value: Column) -> Column:
        return F.to_json(F.struct(name.alias("property"), F.lit(kind).alias("kind"), value.alias("value")))

    literals = {f.name: f.dataType for f in entities.schema["props"].dataType.fields if not isinstance(f.dataType, ArrayType)}
    values = [(label, F.col("title")), (namespace + "abstract", F.col("abstract"))]
    values += [(namespace + c, F.nanvl(F.col("props")[c], F.lit(None).cast("double")) if isinstance(t, DoubleType) else F.col("props")[c]) for c, t in sorted(literals.items())]
    data = F.array_compact(F.array(*[F.when(v.isNotNull(), prop(F.lit(p), "data", v)) for p, v in values]))
    links = edges.groupBy(F.col("s").alias("iri")).agg(F.array_sort(F.collect_set(prop(F.col("p"), "object", F.col("o")))).alias("links"))
    vector = F.to_json(F.struct(F.transform("vector", lambda x: F.round(x.cast("double"), 6)).alias("values"), F.lit(collection).alias("collection")))
    head = F.regexp_replace(F.to_json(F.struct("iri", F.coalesce("types", F.array().cast("array<string>")).alias("classes"))), r"\}\z", "")
    listed = F.array_join(F.concat(data, F.coalesce("links", F.array().cast("array<string>"))), ",")
    tail = F.when(F.col("vector").isNotNull(), F.concat(F.lit(',"vector":'), vector)).otherwise("")
    return entities.join(links, "iri", "left").select("iri", F.concat(head, F.lit(',"properties":['), listed, F.lit("]"), tail, F.lit("}")).alias("body"))


def payload(bodies: DataFrame, per_request: int) -> DataFrame:
    """``batch``, ``body``: rows numbered in full requests of ``per_request`` rows, only the last one smaller.

    Rows are counted within hash classes of the iri, the classes by prefix sums.
    """
    rows = cut(bodies)
    n = max(1, -(-rows.count() // per_request))
    rows = rows.withColumn("_c", F.pmod(F.xxhash64("iri"), F.lit(n)))
    before = rows.groupBy("_c").count().select("_c", F.coalesce(F.sum("count").over(W.orderBy("_c").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    placed = rows.withColumn("_r", F.row_number().over(W.partitionBy("_c").orderBy("iri", "body"))).join(before, "_c")
    return placed.select(F.floor((F.col("_b") + F.col("_r") - 1) / per_request).alias("batch"), "body")


def requests(payload: DataFrame) -> DataFrame:
    """``value``: one line per request, the JSON list of its rows (payload: batch, body)."""
    rows = payload.groupBy("batch").agg(F.sort_array(F.collect_list("body")).alias("rows"))
    return rows.select(F.concat(F.lit("["), F.array_join("rows", ","), F.lit("]")).alias("value"))


def write_manifest(path: str, content: dict) -> None:
    Path(path).write_text(json.dumps(content, sort_keys=True, indent=2) + "\n")


def format_turtle(df: DataFrame) -> DataFrame:
    """``value``: one block of Turtle per subject of s, p, o, o_is_iri, lang, datatype; predicates and objects in order."""
    node = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(F.concat(F.lit("<"), F.col("s"), F.lit(">")))
    pair = F.concat(F.lit("    <"), F.col("p"), F.lit("> "), format_object(*[F.col(c) for c in ("o", "o_is_iri", "lang", "datatype")]))
    listed = df.select(node.alias("s"), pair.alias("x")).groupBy("s").agg(F.array_join(F.sort_array(F.collect_set("x")), " ;\n").alias("x"))
    return listed.select(F.concat("s", F.lit("\n"), "x", F.lit(" .")).alias("value"))


_RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"


def _xml(value: Column) -> Column:
    """Escaped for text and attributes; what XML cannot hold becomes U+FFFD."""
    out = F.regexp_replace(value, r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]", "\ufffd")
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def format_rdfxml(df: DataFrame) -> DataFrame:
    """``value``: a whole RDF/XML document in order of ``ord`` and ``value``: head, one description per subject, end.

    Predicates are parted behind the last # or slash; those whose rest is no XML name cannot be written and are left out.
    """
    shape = r"^(.*[#/])([A-Za-z_][A-Za-z0-9_.-]*)\z"
    rows = df.filter(F.col("p").rlike(shape))
    node = lambda c, attribute: F.when(F.col(c).startswith("_:"), F.concat(F.lit(' rdf:nodeID="'), F.substring(c, 3, 1 << 20), F.lit('"'))).otherwise(F.concat(F.lit(f' rdf:{attribute}="'), _xml(F.col(c)), F.lit('"')))
    name, space = F.regexp_extract("p", shape, 2), F.regexp_extract("p", shape, 1)
    open_ = F.concat(F.lit("    <n:"), name, F.lit(' xmlns:n="'), _xml(space), F.lit('"'))
    blank = F.col("o").startswith("_:") & ~F.col("o_is_iri") & F.col("lang").isNull() & F.col("datatype").isNull()
    typed = F.when(F.col("lang").isNotNull(), F.concat(F.lit(' xml:lang="'), F.col("lang"), F.lit('"'))).when(F.col("datatype").isNotNull(), F.concat(F.lit(' rdf:datatype="'), _xml(F.col("datatype")), F.lit('"'))).otherwise("")
    element = F.when(F.col("o_is_iri") | blank, F.concat(open_, node("o", "resource"), F.lit("/>"))).otherwise(F.concat(open_, typed, F.lit(">"), _xml(F.col("o")), F.lit("</n:"), name, F.lit(">")))
    listed = rows.select(node("s", "about").alias("s"), element.alias("x")).groupBy("s").agg(F.array_join(F.sort_array(F.collect_set("x")), "\n").alias("x"))
    body = listed.select(F.lit(1).alias("ord"), F.concat(F.lit("  <rdf:Description"), "s", F.lit(">\n"), "x", F.lit("\n  </rdf:Description>")).alias("value"))
    ends = df.sparkSession.createDataFrame([(0, f'<?xml version="1.0" encoding="UTF-8"?>\n<rdf:RDF xmlns:rdf="{_RDF}">'), (2, "</rdf:RDF>")], "ord int, value string")
    return ends.union(body)


def file_digest(path: Path) -> str:
    """SHA-256 of a file, read in pieces."""
    h = hashlib.sha256()
    with path.open("rb") as f:
        while chunk := f.read(1 << 20):
            h.update(chunk)
    return h.hexdigest()
