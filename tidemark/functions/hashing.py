"""Key and change hashes as built-in Column expressions (md5 over concatenations).

String forms: every input is cast to string and NULL is replaced by a token before
concatenation, so the hash of a row is independent of engine null handling.
Doubles should be cast to DECIMAL before hashing: their string form differs
between engines ('1.0E7' vs '10000000.0').
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import TableSpec

# Fixed values that must equal the reference's for identical hashes.
SURROGATE_SEPARATOR = "-"
CHANGE_SEPARATOR = "|"
SCD_SEPARATOR = "||"
PACKAGE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
CONTENT_NULL_TOKEN = "NULL"
NO_SCD1_TAGGED = "NO_SCD1_COLUMNS_TAGGED"
NO_SCD2_TAGGED = "NO_SCD2_COLUMNS_TAGGED"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_text(c, null_token: str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(null_token))


def md5_concat(cols: Sequence, sep: str, null_token: str = "") -> Column:
    """md5 of the columns as text, NULL -> null_token, joined with sep."""
    parts = [_as_text(c, null_token) for c in cols]
    if not parts:
        raise ValueError("md5_concat needs at least one column")
    if sep == "":
        return F.md5(F.concat(*parts))
    return F.md5(F.concat_ws(sep, *parts))


def surrogate_key(*cols, null_token: str = "") -> Column:
    """Surrogate key: md5(c1 || '-' || c2 ...), NULL rendered as null_token (H1/H2)."""
    return md5_concat(cols, SURROGATE_SEPARATOR, null_token)


def hash_change(spec: TableSpec) -> Column:
    """Change hash over declared columns minus natural keys, audit and *_PK (H3)."""
    return md5_concat(spec.change_columns(), CHANGE_SEPARATOR, "")


def hash_full(spec: TableSpec) -> Column:
    """Full hash over declared columns minus audit columns (H4)."""
    return md5_concat(spec.full_columns(), CHANGE_SEPARATOR, "")


def hash_scd1(spec: TableSpec) -> Column:
    cols = spec.scd1_columns()
    if not cols:
        return F.md5(F.lit(NO_SCD1_TAGGED))
    return md5_concat(cols, SCD_SEPARATOR, "")


def hash_scd2(spec: TableSpec) -> Column:
    cols = spec.scd2_columns()
    if not cols:
        return F.md5(F.lit(NO_SCD2_TAGGED))
    return md5_concat(cols, SCD_SEPARATOR, "")


def content_hash(df: DataFrame, exclude: Sequence[str]) -> Column:
    """Content hash for staging dedup: all columns but `exclude`, NULL -> 'NULL',
    concatenated with no separator (H6; 'a'+'bc' collides with 'ab'+'c' as in the reference)."""
    skip = set(exclude)
    cols = [c for c in df.columns if c not in skip]
    return md5_concat(cols, "", CONTENT_NULL_TOKEN)


def with_hashes(df: DataFrame, spec: TableSpec, change: str = "HASH_CHANGE",
                full: str | None = "HASH_FULL") -> DataFrame:
    """Append change/full hash columns in one projection."""
    extra = [hash_change(spec).alias(change)]
    if full:
        extra.append(hash_full(spec).alias(full))
    return df.select("*", *extra)
