"""Text, JSON and URL helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space between words.
WHITESPACE = r"[\p{Z}\t-\r\x1C-\x1F\x85]+"

# Schemes whose last path segment may carry ``;params``.
SCHEMES_WITH_PARAMS = [
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps", "rtspu",
    "sip", "sips", "mms", "sftp", "tel",
]

_URL = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
)
_PARAMS = r"(?s)^((?:.*/)?[^/;]*);([^/]*)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c: Column | str) -> Column:
    """AG-1: lower-cased words split at white space; the first or last may be empty."""
    return F.split(F.lower(_col(c)), WHITESPACE)


def joined_words(c: Column | str) -> Column:
    """The words that are not empty, joined by one blank: packed for moving, and split fast."""
    return F.trim(F.regexp_replace(F.lower(_col(c)), WHITESPACE, " "))


def split_joined(c: Column | str) -> Column:
    """The words of ``joined_words``."""
    return F.array_remove(F.split(_col(c), " "), "")


# Spark's JSON functions stop after the first complete value. A text is exactly one
# value if it parses both as the only content of an array and as that of an object.


def _in_array(c: Column) -> Column:
    return F.concat(F.lit("["), c, F.lit("]"))


def _in_object(c: Column) -> Column:
    return F.concat(F.lit('{"v":'), c, F.lit("}"))


def strict_json(c: Column | str) -> Column:
    """Parse text to VARIANT; NULL unless the whole text is one JSON value."""
    c = _col(c)
    whole = F.json_object_keys(_in_object(c)).isNotNull()
    return F.when(whole, F.try_variant_get(F.try_parse_json(_in_array(c)), "$[0]", "variant"))


def strict_from_json(c: Column | str, kind: str) -> Column:
    """Parse text to a declared type; NULL unless the whole text is one such value.

    Fields that do not fit their type are NULL, the others are kept.
    """
    c = _col(c)
    whole = F.json_array_length(_in_array(c)).isNotNull()
    typed = F.from_json(_in_object(c), f"v {kind}", {"allowSingleQuotes": "false"})
    return F.when(whole, typed["v"])


def is_json(c: Column | str) -> Column:
    """F-9: whether the text is exactly one JSON value."""
    return strict_json(c).isNotNull()


def json_field(c: Column | str, name: str, kind: str, default: object) -> Column:
    """F-15: field of a VARIANT object, or the default when missing or null."""
    return F.coalesce(F.try_variant_get(_col(c), f"$.{name}", kind), F.lit(default))


def camel_case(c: Column | str) -> Column:
    """F-11: ``queue_source`` becomes ``QueueSource``."""
    parts = F.filter(F.split(F.lower(_col(c)), "_"), lambda p: p != "")
    return F.array_join(
        F.transform(
            parts,
            lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.right(p, F.length(p) - 1)),
        ),
        "",
    )


def url_parts(c: Column | str) -> Column:
    """F-10: struct(scheme, netloc, path, params, query, fragment)."""
    c = _col(c)

    def group(i: int) -> Column:
        return F.regexp_extract(c, _URL, i)

    scheme, path = F.lower(group(1)), group(3)
    has_params = scheme.isin(SCHEMES_WITH_PARAMS) & path.contains(";") & path.rlike(_PARAMS)
    return F.struct(
        scheme.alias("scheme"),
        group(2).alias("netloc"),
        F.when(has_params, F.regexp_extract(path, _PARAMS, 1)).otherwise(path).alias("path"),
        F.when(has_params, F.regexp_extract(path, _PARAMS, 2)).otherwise(F.lit("")).alias("params"),
        group(4).alias("query"),
        group(5).alias("fragment"),
    )
