"""Column functions: URIs, text flags, digests, rendering, config lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings read as "yes", and the one accepted object-store scheme.
TRUE_WORDS = ("1", "true", "yes", "on")
OBJECT_SCHEME = "s3"
LOCAL_SCHEMES = ("", "file")
# End of fixed values.


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uri_parts(uri: Column | str, scheme: str = OBJECT_SCHEME) -> Column:
    """``struct(bucket, key)`` of an object URI, or null when it is not a valid one.

    The query and fragment are cut first; leading slashes of the key are stripped; both
    parts must be non-empty.  The scheme compares without case.
    """
    plain = F.regexp_replace(_col(uri), r"[?#].*$", "")
    pattern = f"^(?i:{scheme})://([^/]+)/+([^/].*)$"
    bucket = F.regexp_extract(plain, pattern, 1)
    key = F.regexp_extract(plain, pattern, 2)
    return F.when(bucket != "", F.struct(bucket.alias("bucket"), key.alias("key")))


def uri_scheme(uri: Column | str) -> Column:
    """Lower-case scheme of a URI, empty when it has none."""
    return F.lower(F.regexp_extract(_col(uri), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def is_local_uri(uri: Column | str) -> Column:
    """True for a plain path or a ``file:`` URI."""
    return uri_scheme(uri).isin(*LOCAL_SCHEMES)


def truthy(text: Column | str) -> Column:
    """True when the trimmed, lower-cased text is one of ``TRUE_WORDS``; null is false."""
    return F.coalesce(F.lower(F.trim(_col(text))).isin(*TRUE_WORDS), F.lit(False))


def blank_to(text: Column | str, default: str) -> Column:
    """The trimmed text, or ``default`` when it is null or blank."""
    return F.coalesce(F.nullif(F.trim(_col(text)), F.lit("")), F.lit(default))


def digest_equal(actual: Column | str, expected: Column | str) -> Column:
    """Compare hex digests; the expected one may carry blanks and upper case."""
    return _col(actual) == F.lower(F.trim(_col(expected)))


def percent_text(value: Column | str) -> Column:
    """``%.0f`` with ties to the even digit (Spark's own formatting rounds them up)."""
    return F.format_string("%.0f", F.bround(_col(value), 0))


def decimals_text(value: Column | str, digits: int = 4) -> Column:
    """Fixed-point text with ``digits`` decimals."""
    return F.format_string(f"%.{digits}f", _col(value))


def round_even(value: Column | str, digits: int) -> Column:
    """Round with ties to the even digit."""
    return F.bround(_col(value), digits)


def epoch_millis(seconds: Column | str) -> Column:
    """Epoch seconds to epoch milliseconds."""
    return _col(seconds) * F.lit(1000)


def percent_of(part: Column, whole: Column) -> Column:
    """``100 * part / whole``; null when the divisor is zero."""
    return F.try_divide(F.lit(100.0) * part, whole)


def config_value(document: Column | str, dotted: str) -> Column:
    """Value at a dotted path of a JSON document, as text; null when missing or null."""
    return F.get_json_object(_col(document), "$." + dotted)


def config_has(document: Column | str, dotted: str) -> Column:
    """True when the path exists, also where its value is null.

    The parent object is listed by its keys, so a present null and a missing key differ.
    """
    *parents, leaf = dotted.split(".")
    parent = (
        F.get_json_object(_col(document), "$." + ".".join(parents)) if parents else _col(document)
    )
    return F.coalesce(F.array_contains(F.json_object_keys(parent), leaf), F.lit(False))


def template(text: str, labels: Column, value: Column | None = None) -> Column:
    """Fill ``{label}`` and ``{value}`` places of ``text`` from a label map and a value.

    A missing label renders as the empty string; the value renders like ``percent_text``.
    """
    import re

    parts: list[Column] = []
    for piece in re.split(r"(\{\w+\})", text):
        if piece == "{value}":
            if value is not None:
                parts.append(F.coalesce(percent_text(value), F.lit("")))
        elif re.fullmatch(r"\{\w+\}", piece):
            parts.append(F.coalesce(F.try_element_at(labels, F.lit(piece[1:-1])), F.lit("")))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")


def row_json(columns: Sequence[str]) -> Column:
    """One row as JSON text with its columns in name order; null fields are left out."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]))


def row_hash(columns: Sequence[str]) -> Column:
    """md5 of a row's content, independent of column order."""
    return F.md5(row_json(columns))
