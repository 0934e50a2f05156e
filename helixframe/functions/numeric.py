"""Rounding and printing of doubles by their exact binary value.

Spark rounds the decimal representation half up; results here must be those of
the exact binary value with ties to even, and text without an exponent.
"""

from __future__ import annotations

from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_text(x: float | None, places: int) -> str | None:
    return None if x is None else f"{x:.{places}f}"


def shortest_text(x: float | None) -> str | None:
    """The shortest digits that give x back, never with an exponent."""
    if x is None:
        return None
    if x != x:
        return "NaN"
    if x in (float("inf"), float("-inf")):
        return "inf" if x > 0 else "-inf"
    s = format(Decimal(repr(float(x))), "f")
    return s[:-2] if s.endswith(".0") else s


def round_exact(x: Column, places: int) -> Column:
    """x rounded to so many places by its exact binary value."""

    def f(s: pd.Series) -> pd.Series:
        return pd.Series([None if v is None or v != v else float(f"{v:.{places}f}") for v in s], dtype="float64")

    return F.pandas_udf(f, "double")(x)


def print_fixed(x: Column, places: int) -> Column:
    def f(s: pd.Series) -> pd.Series:
        return pd.Series([None if v is None or v != v else fixed_text(v, places) for v in s], dtype="object")

    return F.pandas_udf(f, "string")(x)


def print_shortest(x: Column) -> Column:
    def f(s: pd.Series) -> pd.Series:
        return pd.Series([shortest_text(v) for v in s], dtype="object")

    return F.pandas_udf(f, "string")(x)


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
