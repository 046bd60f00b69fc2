"""SQL of the rows that fail to parse: the same cascade of checks in another dialect."""

from __future__ import annotations

IRI = r"""https?://[^<>"{}|^`\\\x00-\x20\x7f-\x9f]+"""
TAG = r"[A-Za-z]{2,8}(?:-[A-Za-z0-9]{1,8})*"
DOUBLE = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
BLANK = "_:[A-Za-z0-9]+"
XSD = "http://schema.example/xsd#"


def value_sql(value: str, kind: str) -> str:
    return f"""CASE {kind} WHEN 'string' THEN true
      WHEN 'integer' THEN regexp_full_match({value}, '[+-]?[0-9]+')
      WHEN 'double' THEN regexp_full_match({value}, '{DOUBLE}')
      WHEN 'date' THEN regexp_full_match({value}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND {value} >= '0001' AND try_cast({value} AS date) IS NOT NULL
      WHEN 'gYear' THEN regexp_full_match({value}, '-?[0-9]{{4}}')
      WHEN 'boolean' THEN {value} IN ('true', 'false', '0', '1') ELSE false END"""


def reason_sql(o: str, is_iri: str, lang: str, datatype: str) -> str:
    known = ", ".join(f"'{XSD}{k}'" for k in ("integer", "double", "date", "gYear", "boolean", "string"))
    fits = value_sql(o, f"substr({datatype}, {len(XSD) + 1})")
    return f"""CASE WHEN {o} IS NULL OR {o} = '' THEN 'empty_object' WHEN {is_iri} IS NULL THEN 'unknown_kind'
      WHEN {is_iri} AND ({lang} IS NOT NULL OR {datatype} IS NOT NULL) THEN 'annotated_iri'
      WHEN {is_iri} AND NOT regexp_full_match({o}, '{IRI}') THEN 'invalid_iri' WHEN {is_iri} THEN NULL
      WHEN {lang} IS NOT NULL AND {datatype} IS NOT NULL THEN 'lang_and_datatype'
      WHEN {lang} IS NOT NULL AND NOT regexp_full_match({lang}, '{TAG}') THEN 'invalid_lang' WHEN {lang} IS NOT NULL THEN NULL
      WHEN {datatype} IS NULL AND regexp_full_match({o}, '{BLANK}') THEN NULL WHEN {datatype} IS NULL THEN 'untyped_literal'
      WHEN {datatype} NOT IN ({known}) THEN 'invalid_datatype' WHEN NOT coalesce({fits}, false) THEN 'invalid_value' END"""


_ESCAPE = r"""\\(?:[tbnrf"''\\]|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8})"""
_SHAPE = r"""(?s)^[ \t]*(<[^<>]*>|_:[^ \t<>"]*)[ \t]+(<[^<>]*>)[ \t]+(<[^<>]*>|_:[^ \t<>".]*|"(.*)"(@[^ \t".]*|\^\^<[^<>"]*>)?)[ \t]*\.[ \t]*\z"""
_PIECE = r"(?s)\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\.|[^\\]+|\\"
_CODE = "('0x' || substr(x, 3))::bigint"
_LETTERS = " ".join(f"WHEN x = '\\{letter}' THEN chr({code})" for letter, code in (("t", 9), ("b", 8), ("n", 10), ("r", 13), ("f", 12)))


def unescaped_sql(value: str) -> str:
    one = rf"""CASE WHEN regexp_matches(x, '^\\[uU][0-9A-Fa-f]{{4}}') THEN CASE WHEN {_CODE} BETWEEN 55296 AND 57343 OR {_CODE} > 1114111 THEN chr(65533) ELSE chr({_CODE}::int) END
        {_LETTERS} WHEN x IN ('\"', '\''', '\\') THEN substr(x, 2) ELSE x END"""
    return rf"""CASE WHEN NOT contains({value}, '\') THEN {value} ELSE array_to_string(list_transform(regexp_extract_all({value}, '{_PIECE}'), lambda x: {one}), '') END"""


_BARE = "CASE WHEN starts_with({0}, '<') THEN substr({0}, 2, length({0}) - 2) ELSE {0} END"
CLASSIFIED = rf"""line AS (SELECT line_id, line AS raw, regexp_matches(line, '{_SHAPE}') AS split, regexp_extract(line, '{_SHAPE}', 1) AS sr, regexp_extract(line, '{_SHAPE}', 2) AS pr,
      regexp_extract(line, '{_SHAPE}', 3) AS ob, regexp_extract(line, '{_SHAPE}', 4) AS inn, regexp_extract(line, '{_SHAPE}', 5) AS suf,
      length(regexp_replace(regexp_replace(line, '{_ESCAPE}', '', 'g'), '[^"]', '', 'g')) AS quotes, regexp_matches(line, '\.[ \t]*\z') AS ends
    FROM raw_lines WHERE line IS NULL OR NOT regexp_matches(line, '^[ \t]*(#|\z)')),
  part AS (SELECT *, starts_with(ob, '"') AS lit, starts_with(ob, '<') AS iri, CASE WHEN starts_with(ob, '"') THEN {unescaped_sql("inn")} ELSE {_BARE.format("ob")} END AS val,
      CASE WHEN starts_with(ob, '"') AND starts_with(suf, '@') THEN substr(suf, 2) END AS lg,
      CASE WHEN starts_with(ob, '"') AND starts_with(suf, '^^') THEN substr(suf, 4, length(suf) - 4) WHEN starts_with(ob, '"') AND suf = '' THEN '{XSD}string' END AS dt FROM line),
  judged AS (SELECT line_id, 'mappingbased_objects' AS origin, s, p, o, o_is_iri, lang, datatype, {reason_sql("o", "o_is_iri", "lang", "datatype")} AS reason, o AS raw FROM mappingbased_objects
    UNION ALL SELECT line_id, 'raw_lines', {_BARE.format("sr")}, {_BARE.format("pr")}, val, iri, lg, CASE WHEN lit AND suf = '' THEN NULL ELSE dt END,
      CASE WHEN raw IS NULL THEN 'null_line' WHEN NOT split AND NOT ends THEN CASE WHEN quotes % 2 = 1 THEN 'broken_quoting' ELSE 'no_terminator' END
        WHEN NOT split AND quotes > 0 AND quotes <> 2 THEN 'broken_quoting' WHEN NOT split THEN 'field_count'
        WHEN NOT regexp_full_match(sr, '<{IRI}>|{BLANK}') THEN 'invalid_subject' WHEN NOT regexp_full_match(pr, '<{IRI}>') THEN 'invalid_predicate'
        WHEN lit AND inn = '' THEN 'empty_object' WHEN lit AND regexp_matches(regexp_replace(inn, '{_ESCAPE}', '', 'g'), '["\\\r\n]') THEN 'broken_quoting'
        WHEN NOT lit AND NOT iri THEN CASE WHEN regexp_full_match(ob, '{BLANK}') THEN NULL ELSE 'invalid_object' END
        ELSE {reason_sql("val", "iri", "lg", "dt")} END, raw FROM part)"""

SQL = {
    "p4_rejects": f"WITH {CLASSIFIED} SELECT line_id, origin, reason, raw FROM judged WHERE reason IS NOT NULL",
    "p4_loaded": f"WITH {CLASSIFIED} SELECT line_id, s, p, o, o_is_iri, lang, datatype FROM judged WHERE reason IS NULL",
}
