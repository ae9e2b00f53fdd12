"""Arithmetic with the reference's integer semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero (T-SQL ``int / int``); null on a zero divisor."""
    return F.when(b != 0, F.call_function("div", a.cast("long"), b.cast("long")))


def int_percent(part: Column, total: Column) -> Column:
    """``100 * part / total`` in integers (truncates, Q23)."""
    return int_div(F.lit(100) * part.cast("long"), total)


def round_ratio(num: Column, den: Column, digits: int = 2, scale: int = 1) -> Column:
    """``ROUND(num * scale / den, digits)`` of non-negative counts, rounded half-up on the exact
    ratio (as a SQL numeric would be) with integer arithmetic, so no engine's binary rounding of a
    half-way double (41 / 40 = 1.025) can move the result."""
    m = 10 ** int(digits)
    q = int_div(F.lit(2 * scale * m) * num.cast("long") + den.cast("long"), F.lit(2) * den.cast("long"))
    return F.when(den != 0, q / F.lit(float(m)))


def round_percent(part: Column, total: Column, digits: int = 2) -> Column:
    """``ROUND(part / total * 100, 2)`` as a real ratio (Q27), exact half-up."""
    return round_ratio(part, total, digits, scale=100)


def int_mean(total: Column, n: Column) -> Column:
    """AVG over integers truncates in T-SQL."""
    return int_div(total, n)


def percent(part: Column, total: Column, integer: bool = True) -> Column:
    """Percent as the reference computes it (truncating integers, Q23) or as a real number."""
    return int_percent(part, total) if integer else F.lit(100.0) * part.cast("double") / total.cast("double")


def mean(total: Column, n: Column, integer: bool = True) -> Column:
    """Mean as the reference computes it (truncating integer AVG, Q23) or as a real number."""
    return int_mean(total, n) if integer else total.cast("double") / n.cast("double")
