"""Scalar text functions on columns, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The one-letter escapes of N-Triples and what they stand for.
LETTER_ESCAPES = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}

# The characters with the Unicode property White_Space.
WHITE_SPACE = " \t\n\x0b\f\r\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"

_PIECE = r"(?s)\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\.|[^\\]+|\\"
_ILLEGAL = r"[\x00-\x20\"<>#%{}|\\^`]"
_ILLEGAL_PIECE = r"(?s)[\x00-\x20\"<>#%{}|\\^`]|[^\x00-\x20\"<>#%{}|\\^`]+"


def code_point(digits: Column) -> Column:
    """The character of a hexadecimal code point; surrogates and values beyond Unicode become U+FFFD."""
    n = F.conv(digits, 16, 10).cast("bigint")
    bad = n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
    safe = F.when(bad, F.lit("0000FFFD")).otherwise(F.lpad(digits, 8, "0"))
    return F.decode(F.unhex(safe), "UTF-32")


def unescape_literal(value: Column) -> Column:
    """Decode the N-Triples escapes in one left-to-right pass; unknown escapes stay as they are."""

    def piece(x: Column) -> Column:
        out = F.when(x.rlike(r"^\\[uU][0-9A-Fa-f]{4}"), code_point(F.substring(x, 3, 8)))
        for letter, char in LETTER_ESCAPES.items():
            out = out.when(x == "\\" + letter, F.lit(char))
        return out.otherwise(x)

    pieces = F.regexp_extract_all(value, F.lit(_PIECE), F.lit(0))
    return F.when(value.contains("\\"), F.array_join(F.transform(pieces, piece), "")).otherwise(value)


def escape_literal(value: Column) -> Column:
    """The reverse for writing: backslash first, then quote and line ends."""
    out = value
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out


def percent_decode(value: Column) -> Column:
    """Percent-decoding as UTF-8; broken escapes and plus signs stay as they are."""
    safe = F.regexp_replace(F.replace(value, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(value.contains("%"), F.url_decode(safe)).otherwise(value)


def reencode_illegal(value: Column) -> Column:
    """Percent-encode only what an IRI may not hold."""
    pieces = F.regexp_extract_all(value, F.lit(_ILLEGAL_PIECE), F.lit(0))
    one = lambda x: F.when(x.rlike(f"^{_ILLEGAL}\\z"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(x)), 2, "0"))).otherwise(x)
    return F.when(value.rlike(_ILLEGAL), F.array_join(F.transform(pieces, one), "")).otherwise(value)


def normalize_iri(value: Column) -> Column:
    """http scheme, lower-case host, no trailing slash; a path with a percent sign is decoded and only its illegal
    characters are encoded again, any other path stays as it is, with the # of a namespace.

    Text that is not an http(s) IRI comes back trimmed.
    """
    x = F.btrim(value, F.lit(" \t\r\n\f\u000b"))
    shape = r"(?is)^https?://([^/]*)(/?.*)\z"
    host, rest = F.lower(F.regexp_extract(x, shape, 1)), F.regexp_extract(x, shape, 2)
    path = F.when(rest.contains("%"), reencode_illegal(percent_decode(rest))).otherwise(rest)
    path = F.when(F.char_length(path) > 1, F.regexp_replace(path, r"(?<=.)/+\z", "")).otherwise(path)
    return F.when(x.rlike(shape) & (host != ""), F.concat(F.lit("http://"), host, path)).otherwise(x)


def normalize_title(title: Column) -> Column:
    """The title as it stands in the normalised IRI of its page, whether it came raw or percent-encoded."""
    path = reencode_illegal(percent_decode(F.btrim(title, F.lit(" \t\r\n\f\u000b"))))
    return F.regexp_replace(path, r"(?<=.)/+\z", "")


def normalize_if_needed(value: Column) -> Column:
    """``normalize_iri`` where a percent sign, https or a trailing slash calls for it; else only a host in capitals is
    lowered, so the # of a namespace stays."""
    needed = value.contains("%") | value.startswith("https://") | value.endswith("/")
    host = F.regexp_extract(value, "^http://([^/]*)", 1)
    lowered = F.concat(F.lit("http://"), F.lower(host), F.substring(value, F.char_length(host) + 8, F.lit(1 << 20)))
    return F.when(needed, normalize_iri(value)).when(host.rlike("[A-Z]"), lowered).otherwise(value)


def local_name(iri: Column) -> Column:
    """What follows the last # or, without one, the last slash; decoded, underscores as blanks."""
    tail = F.when(iri.contains("#"), F.substring_index(iri, "#", -1)).otherwise(F.substring_index(iri, "/", -1))
    return F.translate(percent_decode(tail), "_", " ")


def title_of(iri: Column, prefix: str) -> Column:
    """Title of a resource: the whole path behind ``prefix``, so that titles with a slash stay whole."""
    tail = F.when(iri.startswith(prefix), F.substring(iri, len(prefix) + 1, 1 << 20)).otherwise(F.substring_index(iri, "/", -1))
    return F.translate(percent_decode(tail), "_", " ")


def collapse_space(value: Column) -> Column:
    """Runs of Unicode white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(value, r"(?U)\s+", " "))


def strip_space(value: Column) -> Column:
    """Without Unicode white space at the ends."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def lenient_long(value: Column) -> Column:
    """Trimmed text, with a fraction of zeros allowed, as bigint; null where it is no integer."""
    return F.regexp_replace(F.trim(value), r"\.0+\z", "").try_cast("bigint")


def lenient_double(value: Column) -> Column:
    """Numeric text as double; null for anything else, Java's suffixes d and f included."""
    x = F.trim(value)
    return F.when(x.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"), x.try_cast("double"))
