"""Tokenising and numeric validation of raw comma-separated trip lines.

The raw lines are split on ``,`` without any quoting rules, after trailing
whitespace is removed; numeric fields are accepted exactly when Python's
``int()`` / ``float()`` would accept them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: the text forms accepted by Python's int() and float().
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_TEXT = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*$"
SIGNED_NAN_TEXT = r"^\s*[+-](?i:nan)\s*$"
_TRAILING_SPACE = r"\s+$"


def tokens(line: Column) -> Column:
    """Strip trailing whitespace, split on every comma (empty fields kept)."""
    return F.split(F.regexp_replace(line, _TRAILING_SPACE, ""), ",", -1)


def n_fields(toks: Column) -> Column:
    return F.size(toks)


def field(toks: Column, index: int) -> Column:
    """Zero-based field access; NULL (not an error) past the end."""
    return F.get(toks, F.lit(index))


def is_int_text(c: Column) -> Column:
    return F.coalesce(c.rlike(INT_TEXT), F.lit(False))


def is_float_text(c: Column) -> Column:
    return F.coalesce(c.rlike(FLOAT_TEXT), F.lit(False))


def float_value(c: Column) -> Column:
    """The double a Python ``float(c)`` gives, NULL where it would raise.

    The regex guard matters: Spark alone also accepts ``1d`` or ``0x1p3``.
    Spark's cast trims surrounding whitespace itself but rejects a signed
    NaN, which Python reads as NaN; only then is the fallback evaluated.
    """
    signed_nan = F.when(c.rlike(SIGNED_NAN_TEXT), F.lit(float("nan")))
    return F.when(is_float_text(c), F.coalesce(c.try_cast("double"), signed_nan))
