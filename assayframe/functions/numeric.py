"""Numeric columns with the missing-value rules of the study scripts.

A missing measurement may arrive as null or NaN. Spark orders NaN above every number, so every
comparison here drops both.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

INF = float("inf")


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x: Column | str) -> Column:
    x = _col(x).cast("double")
    return F.when(~F.isnan(x), x)


def safe_gt(x: Column | str, cut) -> Column:
    """x > cut; a missing x is not kept by a filter."""
    return nan_to_null(x) > cut


def safe_lt(x: Column | str, cut) -> Column:
    """x < cut; a missing x is not kept by a filter."""
    return nan_to_null(x) < cut


def avg_skip_nan(x: Column | str) -> Column:
    """Mean over the values that are neither null nor NaN."""
    return F.avg(nan_to_null(x))


def avg_if_complete(x: Column | str) -> Column:
    """Mean that is null as soon as one value of the group is missing."""
    x = nan_to_null(x)
    return F.when(F.count(F.lit(1)) == F.count(x), F.avg(x))


def log2p1(x: Column | str) -> Column:
    return F.log2(_col(x) + 1)


def neg_log10(p: Column | str) -> Column:
    """-log10(p), with +Infinity for p = 0 (Spark's own log10(0) is null)."""
    p = _col(p)
    return F.when(p == 0, F.lit(INF)).otherwise(-F.log10(p))


def log2_ratio(a: Column | str, b: Column | str) -> Column:
    """log2(a / b) with the limits +-Infinity where one side is zero and null where both are."""
    a, b = _col(a), _col(b)
    return (
        F.when((a == 0) & (b == 0), F.lit(None).cast("double"))
        .when(b == 0, F.lit(INF))
        .when(a == 0, F.lit(-INF))
        .otherwise(F.log2(F.try_divide(a, b)))
    )


def pct(share: Column | str, digits: int = 2) -> Column:
    """A share in percent, rounded half to even."""
    return F.bround(_col(share) * 100, digits)


def to_number(x: Column | str) -> Column:
    """Text to double; text that is no number becomes null instead of an error."""
    return _col(x).try_cast("double")


def rt_seconds(x: Column | str, unit: str = "seconds") -> Column:
    """Retention time in seconds."""
    factors = {"seconds": 1, "minutes": 60}
    if unit not in factors:
        raise ValueError(f"unknown retention-time unit {unit!r}")
    return _col(x) * factors[unit]


def label_direction(x: Column | str, up: float = 1.0, down: float = -1.0) -> Column:
    """Upregulated above ``up``, Downregulated below ``down``, else Not Significant."""
    return (
        F.when(safe_gt(x, up), "Upregulated")
        .when(safe_lt(x, down), "Downregulated")
        .otherwise("Not Significant")
    )


def label_sign(x: Column | str) -> Column:
    """Upregulated above zero, else Downregulated (zero included); null stays null."""
    x = nan_to_null(x)
    return F.when(x > 0, "Upregulated").when(x <= 0, "Downregulated")
