"""Numeric guards, rounding and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c) -> Column:
    """Null or NaN (NaN only exists for floating types; other types are cast)."""
    c = _as_col(c)
    return c.isNull() | F.isnan(c.cast("double"))


def not_positive(c) -> Column:
    """N3/N4 guard: null, NaN or <= 0. Spark orders NaN above every number, so a bare
    ``c <= 0`` would let NaN through."""
    c = _as_col(c)
    return is_missing(c) | (c <= 0)


def to_number(c) -> Column:
    """Text or number -> double; unparsable -> null (ANSI-safe)."""
    return F.expr(f"try_cast({_quoted(c)} as double)") if isinstance(c, str) else c.try_cast("double")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def zero_if_missing(c) -> Column:
    """Invalid (null or NaN) counts as 0."""
    c = _as_col(c)
    return F.when(is_missing(c), F.lit(0)).otherwise(c)


def swiss_number(c, decimals: int = 2) -> Column:
    """H9: thousands separated by a back-tick, decimal comma (``1`234`567,89``)."""
    return F.translate(F.format_number(_as_col(c), decimals), ",.", "`,")


def value_problem(value, kind: str, guid, ebkp) -> Column:
    """Null when the value is a positive number, else the reference's message text."""
    v, g, e = _as_col(value), _as_col(guid), _as_col(ebkp)
    where = F.concat(F.lit(" for GUID "), g.cast("string"), F.lit(" (eBKP-H: "), e.cast("string"), F.lit(")"))
    return (
        F.when(is_missing(v), F.concat(F.lit(f"Missing {kind}"), where))
        .when(v <= 0, F.concat(F.lit(f"Invalid {kind} ("), v.cast("string"), F.lit(")"), where))
    )


def is_fractional(dtype) -> bool:
    return isinstance(dtype, (DoubleType, FloatType, DecimalType))
