"""Scalar column helpers (projections, filters, scalar functions).

All of these return built-in Spark ``Column`` expressions, so they stay
inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RFC3339_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
# Strict base64: alphabet only, padded to a multiple of four, no whitespace.
BASE64_RE = r"^([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ts(c) -> Column:
    """String or timestamp -> timestamp (NULL when unparseable)."""
    return col(c).try_cast("timestamp")


def event_date(ts="event_ts") -> Column:
    """UTC date of a timestamp (session time zone must be UTC)."""
    return F.to_date(col(ts))


def as_date(d) -> Column:
    if isinstance(d, (_dt.date, str)):
        return F.lit(str(d)).cast("date")
    return col(d)


def lookback(date_col, as_of, days: int) -> Column:
    """``date_col BETWEEN as_of - days AND as_of`` (inclusive)."""
    a = as_date(as_of)
    return col(date_col).between(F.date_sub(a, int(days)), a)


def minutes_between(start, end) -> Column:
    """P10: whole minutes from ``start`` to ``end``, truncated toward zero
    (signed), like the warehouse's TIMESTAMP_DIFF(end, start, MINUTE)."""
    return F.timestamp_diff("MINUTE", col(start), col(end))


def composite_key(cols, sep: str = "-", null: str | None = "") -> Column:
    """Cast each part to string, NULL -> ``null`` (or keep NULL when
    ``null`` is None), and concatenate with ``sep``."""
    parts = [col(c).cast("string") for c in cols]
    if null is not None:
        parts = [F.coalesce(p, F.lit(null)) for p in parts]
        return F.concat_ws(sep, *parts)
    out = parts[0]
    for p in parts[1:]:
        out = F.concat(out, F.lit(sep), p)
    return out


def rfc3339(ts) -> Column:
    """Timestamp -> RFC 3339 UTC text with microseconds."""
    return F.date_format(col(ts), RFC3339_MICROS)


def unix_micros(ts) -> Column:
    """Timestamp -> epoch microseconds."""
    return F.unix_micros(col(ts))


def event_key(c) -> Column:
    """Contract lookup key: trim, '-' -> '_', upper."""
    return F.upper(F.replace(F.trim(col(c)), F.lit("-"), F.lit("_")))


def decode_payload(c) -> Column:
    """S3: strict base64 -> UTF-8 text, else the raw text.

    Text that is not valid base64, or whose decoded bytes are not valid
    UTF-8, falls through to the raw value."""
    raw = col(c).cast("string")
    strict = raw.rlike(BASE64_RE)
    decoded = F.when(strict, F.try_validate_utf8(F.try_to_binary(raw, F.lit("base64")).cast("string")))
    return F.coalesce(decoded, raw)


def not_null(df: DataFrame, cols) -> DataFrame:
    """Keep rows where every column is non-NULL."""
    cond = None
    for c in cols:
        e = col(c).isNotNull()
        cond = e if cond is None else cond & e
    return df.filter(cond) if cond is not None else df


def of_types(df: DataFrame, types, type_col: str = "event_type") -> DataFrame:
    """P5: event-type equality / IN filter."""
    types = [types] if isinstance(types, str) else list(types)
    c = col(type_col)
    return df.filter(c == types[0] if len(types) == 1 else c.isin(types))
