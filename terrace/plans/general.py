"""Queries of the general problems: hierarchies (p2), rows that fail to parse (p4), attribute-value rows (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators import badrows, hierarchy, widen
from terrace.plans import badrows_sql
from terrace.plans.badrows_sql import DOUBLE, IRI, TAG, value_sql
from terrace.runtime import table


def _split(spark: SparkSession, d: str) -> badrows.Parsed:
    return badrows.split_bad_rows(table(spark, d, "mappingbased_objects"), table(spark, d, "raw_lines"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.cyclic_classes(table(spark, d, "hierarchy_parents"))


def _hierarchy(spark: SparkSession, d: str) -> hierarchy.Hierarchy:
    return hierarchy.build(table(spark, d, "hierarchy_classes"), table(spark, d, "hierarchy_parents"))


def p2_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    h = _hierarchy(spark, d)
    return h.nodes.join(h.paths(), "component").select("cls", "component", "in_cycle", "depth", "root", F.array_join("path", " > ").alias("path"), "n_below")


def p2_ranges(spark: SparkSession, d: str) -> DataFrame:
    """The pairs that the nested ranges hold: a component and each of its descendants in the forest."""
    return hierarchy.contained(_hierarchy(spark, d))


def p2_descendants(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.descendants(_hierarchy(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).rejects.select("line_id")


def p4_rejects(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).rejects


def p4_loaded(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).valid


def _wide(spark: SparkSession, d: str) -> DataFrame:
    return widen.widen(table(spark, d, "mappingbased_literals"), table(spark, d, "attributes"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return widen.conflicting_cells(_wide(spark, d))


def p5_wide(spark: SparkSession, d: str) -> DataFrame:
    wide = _wide(spark, d)
    return wide.withColumn("conflicts", F.array_join("conflicts", ","))


QUERIES = {f.__name__: f for f in (p2_found, p2_hierarchy, p2_ranges, p2_descendants, p4_found, p4_rejects, p4_loaded, p5_found, p5_wide)}

_LINKS = """link AS (SELECT DISTINCT replace(trim(cls, ' \t\n\r'), 'kbo:', 'http://kb.example/ontology/') AS c,
      replace(trim(parent, ' \t\n\r'), 'kbo:', 'http://kb.example/ontology/') AS p
    FROM hierarchy_parents WHERE trim(cls, ' \t\n\r') <> '' AND trim(parent, ' \t\n\r') <> '')"""
_REACH = "reach AS (SELECT c, p FROM link UNION SELECT r.c, l.p FROM reach r JOIN link l ON r.p = l.c)"
_FOREST = f"""WITH RECURSIVE {_LINKS}, {_REACH},
  cls AS (SELECT replace(trim(cls, ' \t\n\r'), 'kbo:', 'http://kb.example/ontology/') AS cls FROM hierarchy_classes
    UNION SELECT replace(trim(cls, ' \t\n\r'), 'kbo:', 'http://kb.example/ontology/') FROM hierarchy_parents
    UNION SELECT p FROM link),
  cyc AS (SELECT a.c AS cls, min(a.p) AS component FROM reach a JOIN reach b ON a.c = b.p AND a.p = b.c GROUP BY 1),
  node AS (SELECT cls.cls, coalesce(cyc.component, cls.cls) AS component, cyc.component IS NOT NULL AS in_cycle
    FROM cls LEFT JOIN cyc ON cls.cls = cyc.cls WHERE cls.cls <> ''),
  lifted AS (SELECT DISTINCT a.component AS c, b.component AS p FROM link JOIN node a ON link.c = a.cls JOIN node b ON link.p = b.cls
    WHERE a.component <> b.component),
  up AS (SELECT c, min(p) AS p FROM lifted GROUP BY c),
  walk AS (SELECT DISTINCT component AS c, component AS root, component AS path, 0 AS depth FROM node WHERE component NOT IN (SELECT c FROM up)
    UNION ALL SELECT up.c, walk.root, walk.path || ' > ' || up.c, walk.depth + 1 FROM walk JOIN up ON up.p = walk.c),
  pair AS (SELECT DISTINCT b.component AS component, a.component AS below
    FROM reach JOIN node a ON reach.c = a.cls JOIN node b ON reach.p = b.cls WHERE a.component <> b.component),
  under AS (SELECT component, count(*) AS n FROM pair GROUP BY 1),
  tree AS (SELECT a.c AS component, b.c AS below FROM walk a JOIN walk b ON a.c <> b.c AND starts_with(b.path, a.path || ' > '))"""

_COLUMNS = {
    "area_km2": "float", "attendance": "int", "birth_date": "date", "catalogue_code": "string", "death_date": "date", "elevation_m": "float",
    "employees": "int", "founding_year": "int", "height_m": "float", "held_on": "date", "lat": "float", "lon": "float", "motto": "string",
    "population": "int", "pseudonym": "string", "release_date": "date", "runtime_min": "float", "top_speed": "float", "units_built": "int",
}
_SLOT = {"int": "i", "float": "f", "date": "d", "string": "t"}
_CELLS = rf"""typed AS (SELECT regexp_replace(url_decode(regexp_replace(s, '^https://', 'http://')), '/+$', '') AS s, colname,
    CASE WHEN coltype = 'int' THEN try_cast(nullif(regexp_extract(x, '^([+-]?[0-9]+)(?:\.0+)?$', 1), '') AS bigint) END AS i,
    CASE WHEN coltype = 'float' AND regexp_full_match(x, '{DOUBLE}') THEN try_cast(x AS double) END AS f,
    CASE WHEN coltype = 'date' AND regexp_full_match(x, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND x >= '0001' THEN try_cast(x AS date) END AS d,
    CASE WHEN coltype = 'string' AND x <> '' THEN x END AS t
  FROM (SELECT s, p, regexp_replace(o, '^\s+|\s+$', '', 'g') AS x FROM mappingbased_literals WHERE s IS NOT NULL) JOIN attributes USING (p)),
  cell AS (SELECT s, colname, min(i) AS i, min(f) AS f, min(d) AS d, min(t) AS t,
    coalesce(min(i) <> max(i), false) OR coalesce(min(f) <> max(f), false) OR coalesce(min(d) <> max(d), false) OR coalesce(min(t) <> max(t), false) AS conflict
  FROM typed GROUP BY 1, 2)"""

SQL = badrows_sql.SQL | {
    "p2_found": f"WITH RECURSIVE {_LINKS}, {_REACH} SELECT c AS cls FROM reach WHERE c = p",
    "p2_hierarchy": _FOREST + """
      SELECT node.cls, node.component, node.in_cycle, walk.depth, walk.root, walk.path,
        coalesce(under.n, 0) AS n_below
      FROM node JOIN walk ON node.component = walk.c LEFT JOIN under ON node.component = under.component""",
    "p2_descendants": f"{_FOREST} SELECT component, below FROM pair",
    "p2_ranges": f"{_FOREST} SELECT component, below FROM tree",
    "p4_found": rf"""SELECT line_id FROM mappingbased_objects WHERE NOT coalesce(o <> '' AND (
      (o_is_iri AND lang IS NULL AND datatype IS NULL AND regexp_full_match(o, '{IRI}'))
      OR (NOT o_is_iri AND lang IS NULL AND datatype IS NULL AND regexp_full_match(o, '_:[A-Za-z0-9]+'))
      OR (NOT o_is_iri AND datatype IS NULL AND regexp_full_match(lang, '{TAG}'))
      OR (NOT o_is_iri AND lang IS NULL AND starts_with(datatype, 'http://schema.example/xsd#') AND {value_sql("o", "substr(datatype, 27)")})), false)
      UNION ALL SELECT line_id FROM (SELECT line_id, line, trim(line, ' ' || chr(9)) AS t,
        regexp_extract(line, '^[ \t]*(?:<{IRI}>|_:[A-Za-z0-9]+)[ \t]+<{IRI}>[ \t]+(.*?)[ \t]*\.[ \t]*$', 1, 's') AS ob FROM raw_lines)
      WHERE NOT coalesce(t = '' OR starts_with(t, '#') OR regexp_full_match(ob, '<{IRI}>|_:[A-Za-z0-9]+')
        OR regexp_full_match(ob, '"(?:[^"\\\n\r]|\\[tbnrf"''\\]|\\u[0-9A-Fa-f]{{4}}|\\U[0-9A-Fa-f]{{8}})+"(?:@{TAG}|\^\^<http://schema\.example/xsd#string>)?')
        OR (regexp_full_match(ob, '"[^"\\\n\r]+"\^\^<http://schema\.example/xsd#[A-Za-z]+>') AND
          {value_sql("regexp_extract(ob, '^\"([^\"]*)\"', 1)", "regexp_extract(ob, 'xsd#([A-Za-z]+)>$', 1)")}), false)""",
    "p5_found": f"WITH {_CELLS} SELECT s, colname FROM cell WHERE conflict",
    "p5_wide": f"WITH {_CELLS} SELECT s, "
    + ", ".join(f"any_value({_SLOT[t]}) FILTER (colname = '{c}') AS {c}" for c, t in _COLUMNS.items())
    + ", coalesce(string_agg(colname, ',' ORDER BY colname) FILTER (conflict), '') AS conflicts FROM cell GROUP BY s",
}
