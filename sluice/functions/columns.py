"""Scalar column builders (P1-P12), all built-in Catalyst expressions.

Each returns a :class:`Column`, so a whole set of derivations collapses into
one projection inside whole-stage codegen. Parsing and casting use the try_*
forms, which give the same result with ANSI mode on or off.
"""

from __future__ import annotations

from typing import Any, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def map_values(col: str | Column, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """CASE col WHEN k THEN v ... ELSE default END (P5). A null col takes the default."""
    c = _c(col)
    items = list(mapping.items())
    if not items:
        return F.lit(default)
    expr = F.when(c == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def map_prefix(col: str | Column, prefixes: Iterable[tuple[str, Any]], default: Any = None) -> Column:
    """First matching text prefix wins (P6): ``LIKE 'CL%'`` style mapping."""
    c = _c(col).cast("string")
    pairs = list(prefixes)
    if not pairs:
        return F.lit(default)
    expr = F.when(c.startswith(pairs[0][0]), F.lit(pairs[0][1]))
    for p, v in pairs[1:]:
        expr = expr.when(c.startswith(p), F.lit(v))
    return expr.otherwise(F.lit(default))


def strip_cast(col: str | Column, pattern: str, to: str) -> Column:
    """Remove ``pattern`` matches, then try_cast (P4); overflow or junk -> null."""
    return F.regexp_replace(_c(col).cast("string"), pattern, "").try_cast(to)


def parse_date(col: str | Column, fmt: str) -> Column:
    """Text -> date with a Spark datetime pattern (P8); unparsable -> null."""
    return F.try_to_date(_c(col).cast("string"), fmt)


def parse_timestamp(col: str | Column, fmt: str) -> Column:
    """Text -> timestamp in the session time zone (P9); unparsable -> null."""
    return F.try_to_timestamp(_c(col).cast("string"), F.lit(fmt))


def to_type(col: str | Column, spark_type: str) -> Column:
    """try_cast to a Spark SQL type name."""
    return _c(col).try_cast(spark_type)


def load_timestamp(run_ts: Any = None) -> Column:
    """The load timestamp (P10): a caller-fixed literal for repeatable runs,
    else ``current_timestamp()`` (one value per query)."""
    if run_ts is None:
        return F.current_timestamp()
    if isinstance(run_ts, Column):
        return run_ts
    return F.lit(run_ts).cast("timestamp")


def default_if_blank(col: str | Column, default: Any) -> Column:
    """Null or empty text -> default (used by lookups and surrogate ids)."""
    c = _c(col)
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))
