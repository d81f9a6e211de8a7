"""Column -> Column helpers for the projection layer (all built-in, codegen friendly)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.literals import lit


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- strings

def trim_string(c) -> Column:
    """Collapse runs of spaces to one and trim spaces at both ends (tabs are kept)."""
    return F.trim(F.regexp_replace(_col(c), " +", " "))


def truncate(c, width: int) -> Column:
    """varchar(n) cast semantics: keep the first n characters."""
    return F.substring(_col(c), 1, width)


def concat_strict(sep: str, *cols) -> Column:
    """CONCAT_WS that returns NULL when any part is NULL (trap T2)."""
    return F.concat(*[x for c in cols for x in (F.lit(sep), _col(c))][1:])


def pad_left(c, width: int, fill: str = "0") -> Column:
    """Pad a text to `width` characters; a longer one stays whole (`lpad` would cut it)."""
    c = _col(c).cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def composite_key(cols: Sequence, sep: str = "-", pads: Mapping | None = None) -> Column:
    """Composite string key; `pads` maps a position to (width, fill) for `pad_left`. NULL propagates."""
    pads = pads or {}
    parts = []
    for i, c in enumerate(cols):
        e = _col(c).cast("string")
        if i in pads:
            w, fill = pads[i]
            e = pad_left(e, w, fill)
        parts.append(e)
    return concat_strict(sep, *parts)


def project(df, spec):
    """Typed rename projection (P1): `spec` is a list of (source column or Column, target
    name, Spark type or None, width or None); strings are truncated to their declared
    width (varchar(n) semantics). One select, never a chain of withColumn."""
    cols = []
    for src, dst, typ, width in spec:
        e = _col(src)
        if typ is not None:
            e = e.cast(typ)
        if width is not None:
            e = F.substring(e, 1, width)
        cols.append(e.alias(dst))
    return df.select(*cols)


def recent(df, ts, years: int, as_of):
    """Rows newer than `years` before `as_of` (P21): ts > add_months(as_of, -12 * years)."""
    cutoff = F.add_months(F.lit(as_of), -12 * years).cast("timestamp_ntz")
    return df.filter(_col(ts) > cutoff)


def active_only(df, flag, active_value=False):
    """Soft-delete / active filter (P20): keep rows whose flag equals `active_value`."""
    return df.filter(_col(flag) == F.lit(active_value))


# ---------------------------------------------------------------- decode / flags

def decode(c, mapping: Mapping, default=None, passthrough: bool = True) -> Column:
    """Ordered CASE: code -> label; unmatched goes to `default` or passes through."""
    col = _col(c)
    expr = None
    for k, v in mapping.items():
        cond = col == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    other = F.lit(default) if default is not None else (col if passthrough else F.lit(None))
    return other if expr is None else expr.otherwise(other)


def flag(c, true_values: Sequence, out=("Y", "N")) -> Column:
    """Set-membership flag; NULL goes to the false side."""
    t, f = out
    return F.when(_col(c).isin(list(true_values)), F.lit(t)).otherwise(F.lit(f))


def sentinel_to_null(c, values: Sequence) -> Column:
    return F.when(_col(c).isin(list(values)), F.lit(None)).otherwise(_col(c))


def null_to_sentinel(c, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))


def classify(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Ordered rule list, first match wins."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def schedule_label(count, period, on_call=None) -> Column:
    """Label from a count and a period length in weeks."""
    n, p = _col(count), _col(period)
    expr = F.when(F.lit(False), F.lit(None))
    if on_call is not None:
        expr = F.when(_col(on_call) == F.lit("Y"), F.lit("OnCall"))
    return (expr.when((n == 0) | (p == 0), F.lit("None"))
            .when(p == 52, F.concat(n.cast("string"), F.lit(" Per Year")))
            .when(p == 1, F.concat(n.cast("string"), F.lit(" Every Week")))
            .when(p == 4, F.concat(n.cast("string"), F.lit(" Per Month")))
            .otherwise(F.concat(n.cast("string"), F.lit(" Every "), p.cast("string"), F.lit(" Weeks"))))


def guarded_ratio(num, den, scale=None) -> Column:
    """num / den with a zero (or NULL) denominator giving 0."""
    d = _col(den)
    q = _col(num) / d
    if scale is not None:
        q = q * scale
    return F.when(F.coalesce(d, F.lit(0)) == 0, F.lit(0)).otherwise(q)


def blank_if(c, literals: Sequence[str] = (), prefixes: Sequence[str] = ()) -> Column:
    """Blank out junk values given as whole literals or prefixes."""
    col = _col(c)
    conds = [col == F.lit(v) for v in literals]
    conds += [F.substring(col, 1, len(p)) == F.lit(p) for p in prefixes]
    if not conds:
        return col
    return F.when(reduce(lambda a, b: a | b, conds), F.lit("")).otherwise(col)


# ---------------------------------------------------------------- dates and numbers

def try_number(c, to: str = "decimal(38,0)") -> Column:
    """Tolerant numeric cast: blank -> NULL, bad text -> NULL."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit("")).try_cast(to)


def parse_yyyymmdd(c) -> Column:
    """Integer / text YYYYMMDD -> date; 0, NULL and invalid -> NULL.

    Validated arithmetically (month 1-12, day within the month) and built with
    make_date, so invalid inputs never go through a throwing parser: this runs on
    every row of wide tables."""
    s = _col(c).cast("string")
    ok = s.rlike(r"^[0-9]{8}\z")
    y = F.substring(s, 1, 4).try_cast("int")
    m = F.substring(s, 5, 2).try_cast("int")
    d = F.substring(s, 7, 2).try_cast("int")
    month_ok = ok & (y >= 1) & m.between(1, 12)
    month_end = F.dayofmonth(F.last_day(F.when(month_ok, F.make_date(y, m, F.lit(1)))))
    return F.when(month_ok & (d >= 1) & (d <= month_end), F.make_date(y, m, d))


def date_check(c, bad: str | None = None, min_year: int | None = None) -> Column:
    """Tolerant YYYYMMDD parse with a sentinel for invalid input.

    bad=None keeps NULL, 'low' -> 1700-01-01, 'high' -> 4000-12-31 (the two values the
    silver layer treats as empty). min_year marks earlier years invalid. Several forms of one
    column should share its parse: project `parse_yyyymmdd` once and use `checked_date`.
    """
    return checked_date(parse_yyyymmdd(c), bad, min_year)


def checked_date(parsed, bad: str | None = None, min_year: int | None = None) -> Column:
    """`date_check` on a date that is parsed already (NULL: invalid)."""
    d = _col(parsed)
    if min_year is not None:
        d = F.when(F.year(d) >= min_year, d)
    if bad is None:
        return d
    sentinel = {"low": _dt.date(1700, 1, 1), "high": _dt.date(4000, 12, 31)}[bad]
    return F.coalesce(d, F.lit(sentinel))


def parse_capture_ts(c) -> Column:
    """First 17 digits yyyyMMddHHmmssSSS of a CDC capture stamp -> timestamp_ntz."""
    s = F.substring(F.trim(_col(c)), 1, 17)
    txt = F.concat(F.substring(s, 1, 14), F.lit("."), F.substring(s, 15, 3))
    return F.try_to_timestamp(txt, F.lit("yyyyMMddHHmmss.SSS")).cast("timestamp_ntz")


def capture_stamp(ts) -> Column:
    """Inverse of parse_capture_ts: timestamp -> 17-digit text."""
    return F.date_format(_col(ts), "yyyyMMddHHmmssSSS")


def batch_id(ts) -> Column:
    """17-digit batch id yyyyMMddHHmmssSSS as bigint."""
    return F.date_format(_col(ts), "yyyyMMddHHmmssSSS").cast("bigint")


def stamp_columns(as_of: _dt.datetime) -> list[Column]:
    """Batch id + batch timestamp constant for a run (P3); literals, no join needed."""
    ts = lit(as_of).cast("timestamp_ntz")
    return [batch_id(ts).alias("BATCH_ID"), ts.alias("BATCH_TIMESTAMP")]


# ---------------------------------------------------------------- address

def _verified(flag, value, otherwise: Column) -> Column:
    return otherwise if flag is None else F.when(_col(flag) == F.lit("Y"), _col(value)).otherwise(otherwise)


def postal_split(c, verified_flag=None, v_code=None, v_suffix=None) -> tuple[Column, Column]:
    """5+4 split for 'ddddd-dddd', 'ddddddddd', 'ddddd dddd', 'ddddd-'; else as is / ''. The verified
    address's code and suffix come first where its indicator is 'Y'."""
    t = F.trim(_col(c))
    five_four = t.rlike(r"^[0-9]{5}-[0-9]{4}\z")
    nine = t.rlike(r"^[0-9]{9}\z")
    five_sp_four = t.rlike(r"^[0-9]{5} [0-9]{4}\z")
    five_dash = t.rlike(r"^[0-9]{5}-\z")
    code = (F.when(_col(c).isNull(), F.lit(""))
            .when(five_four | nine | five_sp_four | five_dash, F.substring(t, 1, 5))
            .otherwise(t))
    suffix = (F.when(_col(c).isNull(), F.lit(""))
              .when(five_four | five_sp_four, F.substring(t, 7, 4))
              .when(nine, F.substring(t, 6, 4))
              .otherwise(F.lit("")))
    return _verified(verified_flag, v_code, code), _verified(verified_flag, v_suffix, suffix)


# Spellings recognised as the United States, and the normalised outputs.
US_SYNONYMS = ("USA", "US", "UNITED STATES")
US_CODE = "USA"
US_NAME = "UNITED STATES OF AMERICA"


def country_norm(c, verified_flag=None, v_code=None, v_name=None) -> tuple[Column, Column]:
    """(code, name): strip non-letters, map US synonyms; else upper(trim(c)). The verified
    address's code and name come first where its indicator is 'Y'."""
    up = F.upper(F.trim(_col(c)))
    letters = F.regexp_replace(up, "[^A-Za-z ]", "")
    is_us = letters.isin(list(US_SYNONYMS))
    return (F.upper(_verified(verified_flag, v_code, F.when(is_us, F.lit(US_CODE)).otherwise(up))),
            _verified(verified_flag, v_name, F.when(is_us, F.lit(US_NAME)).otherwise(up)))


def _blank(c) -> Column:
    return _col(c).isNull() | (F.trim(_col(c)) == F.lit(""))


def corrected_address(l1, l2, l3, verified_flag=None, v1=None, v2=None, v3=None):
    """Prefer the verified address when its indicator is 'Y'; otherwise close the gaps that blank
    first and second lines leave (P13): the lines in use, then the third as it is, then
    empty lines. Returns three Columns."""
    used = F.array_compact(F.array(*[F.when(~_blank(x), _col(x)) for x in (l1, l2)]))
    lines = F.concat(used, F.array(_col(l3), F.lit(""), F.lit("")))
    out = [F.get(lines, i) for i in range(3)]
    return tuple(_verified(verified_flag, v, x) for v, x in zip((v1, v2, v3), out))


def geo_point(lat, lon) -> Column:
    """struct(lon, lat) when both are in range, else NULL."""
    ok = _col(lat).between(-90, 90) & _col(lon).between(-180, 180)
    return F.when(ok, F.struct(_col(lon).alias("lon"), _col(lat).alias("lat")))


# ---------------------------------------------------------------- status

def action_code(deleted, created, modified) -> Column:
    """deleted -> D, created = modified -> I, created <> modified -> U, else I."""
    return (F.when(_col(deleted) == F.lit(True), F.lit("D"))
            .when(_col(created) == _col(modified), F.lit("I"))
            .when(_col(created) != _col(modified), F.lit("U"))
            .otherwise(F.lit("I")))


def status_asof(ts, as_of, active="ACTIVE", inactive="INACTIVE") -> Column:
    """Compare with a fixed run time; NULL goes to the ELSE side."""
    return F.when(_col(ts) >= lit(as_of), F.lit(active)).otherwise(F.lit(inactive))


# ------------------------------------------------------------------ semi-structured values

def parse_variant(text) -> Column:
    """Text as a VARIANT; NULL where it is not valid JSON (the tolerant parse)."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def variant_value(value, path, kind: str) -> Column:
    """The typed value at `path` (text or a Column) of a VARIANT; NULL where the path is missing or the value does
    not fit the type."""
    return F.try_variant_get(F.col(value) if isinstance(value, str) else value, path, kind)
