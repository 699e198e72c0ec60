"""Secret scanning over text columns and string walking over nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import stored

# Fingerprints of well-known secrets, names that mark a credential, and the
# beginnings of values that are plainly placeholders.
FINGERPRINTS = {
    "AWS access key id": "AKIA[0-9A-Z]{16}",
    "GitHub token": "gh[pousr]_[A-Za-z0-9]{20,}",
    "Slack token": "xox[baprs]-[A-Za-z0-9-]{10,}",
    "private key block": "-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
}
CREDENTIAL_NAME = "password|passwd|secret|token|api[_-]?key|credential"
PLACEHOLDER_START = "replace_with|changeme|<.*>|placeholder|example|dummy|xxx+|\\$\\{"
# End of fixed values.

# name = "value", where the name holds a credential word.
_QUOTED = '=[ \\t]*"[^"]'
_LITERAL = f'(?i)([A-Za-z0-9_-]*(?:{CREDENTIAL_NAME})[A-Za-z0-9_-]*)[ \\t]*=[ \\t]*"([^"]+)"'


def secret_fingerprints(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, kind)``: one finding per item and kind of secret.  Whole texts, no shuffle."""
    kinds = F.array(
        *[F.when(F.col(text).rlike(p), F.lit(kind)) for kind, p in FINGERPRINTS.items()]
    )
    return df.select(F.col(key), F.explode(F.array_compact(kinds)).alias("kind"))


def fingerprint_spans(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, kind, hits)``: how often each kind occurs in each item."""
    kinds = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.regexp_count(F.col(text), F.lit(p)).alias("hits"))
            for kind, p in FINGERPRINTS.items()
        ]
    )
    return df.select(F.col(key), F.inline(kinds)).where("hits > 0")


def credential_literals(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, name, value_md5)`` for each quoted credential that is not a placeholder.

    The value itself is never put into the result, only its digest.
    """
    spans = F.explode(F.regexp_extract_all(F.col(text), F.lit(_LITERAL), F.lit(0)))
    value = F.trim(F.regexp_extract("_span", _LITERAL, 2))
    return (
        # Every literal holds an equals sign before a quote.  That test is many times cheaper
        # than the full pattern, and few texts pass it.
        df.where(F.col(text).rlike(_QUOTED))
        .select(F.col(key), spans.alias("_span"))
        .where((value != "") & ~value.rlike(f"(?i)^(?:{PLACEHOLDER_START})"))
        .select(
            key,
            F.regexp_extract("_span", _LITERAL, 1).alias("name"),
            F.md5(value).alias("value_md5"),
        )
    )


def credential_entries(entries: DataFrame, name: str = "name", value: str = "value") -> DataFrame:
    """Rows of (name, value) pairs whose name marks a credential and whose value is real."""
    v = F.trim(F.col(value))
    return entries.where(
        F.col(name).rlike(f"(?i)(?:{CREDENTIAL_NAME})")
        & (v != "")
        & ~v.rlike(f"(?i)^(?:{PLACEHOLDER_START})")
    )


def walk_strings(df: DataFrame, key: str, document: str, depth: int | None = None) -> DataFrame:
    """``(key, path, value, status)`` for every scalar under a JSON document, its value as text.

    Objects and arrays are opened level by level (array places read ``[0]``) until none is
    left; each level is stored, so a level is parsed once and the walk has no depth limit.
    ``depth`` may state how many levels there are: then nothing is stored, and a deeper
    document raises.  A document that is a scalar itself has an empty path; one that cannot
    be parsed gives one row of status ``malformed`` with its text, all others are ``ok``.  A
    null document has no rows.
    """
    container = F.schema_of_variant("_v").rlike("^(OBJECT|ARRAY)<")
    text = F.variant_get("_v", "$", "string")
    parsed = df.where(F.col(document).isNotNull()).select(
        F.col(key), F.lit("").alias("path"), F.col(document).alias("_text"), F.try_parse_json(F.col(document)).alias("_v")
    )
    broken = parsed.where("_v is null").select(key, F.lit(None).cast("string").alias("path"), F.col("_text").alias("value"), F.lit("malformed").alias("status"))
    rows = parsed.where("_v is not null").select(key, "path", "_v")
    if depth is not None:
        for _ in range(depth):
            rows = _opened(rows, key, container)
        deeper = F.raise_error(F.lit(f"document nested deeper than {depth} levels")).cast("string")
        found = rows.select(key, "path", F.when(container, deeper).otherwise(text).alias("value"))
        return found.withColumn("status", F.lit("ok")).union(broken)
    # Variants cannot be stored in every format; a level is kept as JSON text.
    done = None
    while True:
        flat = stored(rows.select(key, "path", F.to_json("_v").alias("_json"), container.alias("_open"), text.alias("value")), "level")
        leaves = flat.where("not _open").select(key, "path", "value")
        done = leaves if done is None else done.union(leaves)
        inner = flat.where("_open").select(key, "path", F.parse_json("_json").alias("_v"))
        if flat.where("_open").isEmpty():
            return done.withColumn("status", F.lit("ok")).union(broken)
        rows = _opened(inner, key, container)


def _opened(rows: DataFrame, key: str, container: Column) -> DataFrame:
    """Objects and arrays replaced by what is in them; scalars pass unchanged."""
    dot = F.when(F.col("path") == "", "").otherwise(".")
    step = F.when(F.col("_key").isNull(), F.format_string("[%d]", F.col("_pos"))).otherwise(
        F.concat(dot, F.col("_key"))
    )
    return (
        rows.withColumn("_open", container)
        .withColumn("_inside", F.when(F.col("_open"), F.col("_v")))
        .lateralJoin(
            rows.sparkSession.tvf.variant_explode_outer(F.col("_inside").outer()).toDF("_pos", "_key", "_inner")
        )
        # An empty object or array has nothing in it.
        .where(~F.col("_open") | F.col("_pos").isNotNull())
        .select(
            key,
            F.when(F.col("_open"), F.concat("path", step)).otherwise(F.col("path")).alias("path"),
            F.when(F.col("_open"), F.col("_inner")).otherwise(F.col("_v")).alias("_v"),
        )
    )
