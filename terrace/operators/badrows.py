"""Rows that fail to parse: separate them with a reason while loading the valid ones.

Lines and rows are read permissively under one explicit schema that keeps the raw text. Whatever does not parse
keeps its raw text and is classified again by field count, quoting and cast checks. Everything is a projection of
built-in expressions over one scan: no shuffle, no Python.

Defined results: a null or empty ``o`` is rejected as ``empty_object``; a null line is rejected as ``null_line``;
blank lines and comments are neither statements nor rejects; repeated rows are judged each on its own; an empty
table gives empty results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import unescape_literal
from terrace.runtime import full_match

# The accepted datatypes and the shapes of IRIs, tags, blank nodes and typed values.
XSD = "http://schema.example/xsd#"
DATATYPES = ("integer", "double", "date", "gYear", "boolean", "string")
IRI = r"https?://[^<>\"{}|^`\\\x00-\x20\x7f-\x9f]+"
BLANK_NODE = r"_:[A-Za-z0-9]+"
TAG = r"[A-Za-z]{2,8}(?:-[A-Za-z0-9]{1,8})*"
INTEGER = r"[+-]?[0-9]+"
DOUBLE = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
G_YEAR = r"-?[0-9]{4}"
BOOLEAN = r"true|false|0|1"
ESCAPE = r"\\(?:[tbnrf\"'\\]|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8})"


def real_day(value: Column) -> Column:
    """True for YYYY-MM-DD that names a day of the Gregorian calendar, years 0001 to 9999."""
    return full_match(value, DATE) & ~value.startswith("0000") & value.try_cast("date").isNotNull()


def value_fits(value: Column, kind: Column) -> Column:
    """Does the text fit the datatype of local name ``kind``? Null for unknown kinds."""
    return (
        F.when(kind == "string", F.lit(True))
        .when(kind == "integer", full_match(value, INTEGER))
        .when(kind == "double", full_match(value, DOUBLE))
        .when(kind == "date", real_day(value))
        .when(kind == "gYear", full_match(value, G_YEAR))
        .when(kind == "boolean", full_match(value, BOOLEAN))
    )


def _object_reason(
    o: Column, o_is_iri: Column, lang: Column, datatype: Column
) -> Column:
    """Null for a well-formed object, else the reason it is not."""
    known = datatype.isin([XSD + k for k in DATATYPES])
    kind = F.substring(datatype, len(XSD) + 1, 20)
    plain = lang.isNull() & datatype.isNull()
    return (
        F.when(o.isNull() | (o == ""), F.lit("empty_object"))
        .when(o_is_iri.isNull(), F.lit("unknown_kind"))
        .when(o_is_iri & ~plain, F.lit("annotated_iri"))
        .when(o_is_iri & ~full_match(o, IRI), F.lit("invalid_iri"))
        .when(o_is_iri, F.lit(None).cast("string"))
        .when(lang.isNotNull() & datatype.isNotNull(), F.lit("lang_and_datatype"))
        .when(lang.isNotNull() & ~full_match(lang, TAG), F.lit("invalid_lang"))
        .when(lang.isNotNull(), F.lit(None).cast("string"))
        .when(datatype.isNull() & full_match(o, BLANK_NODE), F.lit(None).cast("string"))
        .when(datatype.isNull(), F.lit("untyped_literal"))
        .when(~known, F.lit("invalid_datatype"))
        .when(~value_fits(o, kind), F.lit("invalid_value"))
    )


def classify_objects(df: DataFrame) -> DataFrame:
    """mappingbased_objects rows with ``reason`` (null: valid) and the raw text of the object."""
    reason = _object_reason(F.col("o"), F.col("o_is_iri"), F.col("lang"), F.col("datatype"))
    return df.select(
        "line_id", F.lit("mappingbased_objects").alias("origin"), "s", "p", "o", "o_is_iri", "lang", "datatype",
        reason.alias("reason"), F.col("o").alias("raw"),
    )


def read_lines(df: DataFrame) -> DataFrame:
    """Permissive read of N-Triples lines: parsed fields where the line splits, raw text always, ``kind`` of line.

    The literal is taken from the first quote after the predicate to the last quote of the line; whether its inside
    is well quoted is judged afterwards, so no backtracking pattern runs over long literals.
    """
    line = F.col("line")
    shape = r'(?s)^[ \t]*(<[^<>]*>|_:[^ \t<>"]*)[ \t]+(<[^<>]*>)[ \t]+(<[^<>]*>|_:[^ \t<>".]*|"(.*)"(@[^ \t".]*|\^\^<[^<>"]*>)?)[ \t]*\.[ \t]*\z'
    got = lambda n: F.regexp_extract(line, shape, n)
    parsed = df.select(
        "line_id",
        line.alias("raw"),
        F.when(line.isNull(), "null")
        .when(line.rlike(r"^[ \t]*\z"), "blank")
        .when(line.rlike(r"^[ \t]*#"), "comment")
        .when(line.rlike(shape), "split")
        .otherwise("corrupt")
        .alias("kind"),
        got(1).alias("s_raw"), got(2).alias("p_raw"), got(3).alias("o_raw"), got(4).alias("inner"), got(5).alias("suffix"),
    )
    return parsed


def classify_lines(df: DataFrame) -> DataFrame:
    """raw_lines rows that are statements or should be: parsed columns and ``reason`` (null: valid)."""
    r = read_lines(df).filter(~F.col("kind").isin("blank", "comment"))
    raw, s, p, o, inner, suffix = (F.col(c) for c in ("raw", "s_raw", "p_raw", "o_raw", "inner", "suffix"))
    strip = lambda c: F.substring(c, F.lit(2), F.char_length(c) - 2)
    node = lambda c: F.when(c.startswith("<"), strip(c)).otherwise(c)
    literal, is_iri = o.startswith('"'), o.startswith("<")
    lang = F.when(literal & suffix.startswith("@"), F.substring(suffix, 2, 1 << 20))
    datatype = (
        F.when(literal & suffix.startswith("^^"), F.substring(suffix, F.lit(4), F.char_length(suffix) - 4))
        .when(literal & (suffix == ""), F.lit(XSD + "string"))
    )
    bare = F.regexp_replace(inner, ESCAPE, "")
    quoted_well = ~bare.rlike(r'["\\\r\n]')
    value = F.when(literal, unescape_literal(inner)).otherwise(node(o))
    iri_ok = lambda c: full_match(c, f"<{IRI}>")
    node_ok = lambda c: full_match(c, f"<{IRI}>|{BLANK_NODE}")
    ends = raw.rlike(r"\.[ \t]*\z")
    quotes = F.char_length(F.regexp_replace(F.regexp_replace(raw, ESCAPE, ""), '[^"]', ""))
    reason = (
        F.when(F.col("kind") == "null", F.lit("null_line"))
        .when((F.col("kind") == "corrupt") & ~ends, F.when(quotes % 2 == 1, "broken_quoting").otherwise("no_terminator"))
        .when((F.col("kind") == "corrupt") & (quotes > 0) & (quotes != 2), F.lit("broken_quoting"))
        .when(F.col("kind") == "corrupt", F.lit("field_count"))
        .when(~node_ok(s), F.lit("invalid_subject"))
        .when(~iri_ok(p), F.lit("invalid_predicate"))
        .when(literal & (inner == ""), F.lit("empty_object"))
        .when(literal & ~quoted_well, F.lit("broken_quoting"))
        .when(~literal & ~is_iri & ~full_match(o, BLANK_NODE), F.lit("invalid_object"))
        .when(~literal & ~is_iri, F.lit(None).cast("string"))
        .otherwise(_object_reason(value, is_iri, lang, datatype))
    )
    return r.select(
        "line_id", F.lit("raw_lines").alias("origin"), node(s).alias("s"), node(p).alias("p"), value.alias("o"),
        is_iri.alias("o_is_iri"), lang.alias("lang"), F.when(literal & (suffix == ""), F.lit(None).cast("string")).otherwise(datatype).alias("datatype"),
        reason.alias("reason"), "raw",
    )


@dataclass
class Parsed:
    valid: DataFrame
    rejects: DataFrame


def split_bad_rows(objects: DataFrame, lines: DataFrame) -> Parsed:
    """Both inputs read once each; ``valid`` has the triple columns, ``rejects`` the reason and the raw text."""
    both = classify_objects(objects).unionByName(classify_lines(lines))
    valid = both.filter(F.col("reason").isNull()).select("line_id", "s", "p", "o", "o_is_iri", "lang", "datatype")
    rejects = both.filter(F.col("reason").isNotNull()).select("line_id", "origin", "reason", "raw")
    return Parsed(valid, rejects)
