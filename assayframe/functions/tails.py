"""Tail probabilities as Spark column expressions (no Python workers, no tables to broadcast).

All are power series or finite sums of positive terms, so small tails keep their relative precision.
Arguments are bound once by :func:`let`: a formula that names its argument ten times would otherwise put
ten copies of the argument's own expression into the plan.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, functions as F

# fixed values: coefficients of Stirling's series
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360, 1 / 156)


def _col(x: Column | str | float) -> Column:
    if isinstance(x, str):
        return F.col(x)
    return x if isinstance(x, Column) else F.lit(float(x))


def let(body: Callable[[Column], Column], **values: Column | str | float) -> Column:
    """Evaluate the values once, as doubles, and hand them to ``body`` as fields of one struct."""
    bound = F.struct(*[_col(v).cast("double").alias(k) for k, v in values.items()])
    return F.get(F.transform(F.array(bound), body), 0)


def once(value: Column) -> Column:
    """The same value, kept in the one projection that names it.

    The optimiser copies a projected expression into every filter on it. For a tail probability that
    multiplies the plan and the work; it does not move expressions that depend on the row number.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def _sum_terms(first: int, last: Column | int, start: Column, ratio: Callable[[Column], Column]) -> Column:
    """start * (1 + r(first) + r(first) r(first + 1) + …) up to ``last``; just start if last < first."""
    last = last if isinstance(last, Column) else F.lit(last)
    steps = F.when(last >= first, F.sequence(F.lit(first), last.cast("int"))).otherwise(F.array().cast("array<int>"))

    def add(acc: Column, j: Column) -> Column:
        return F.struct((acc["s"] + acc["t"]).alias("s"), (acc["t"] * ratio(j + 1)).alias("t"))

    # the running term is one step ahead of the sum, so each ratio is evaluated once
    zero = F.struct(F.lit(1.0).alias("s"), ratio(F.lit(first)).alias("t"))
    return start * F.aggregate(steps, zero, add, lambda acc: acc["s"])


def ln_gamma(z: Column | str | float) -> Column:
    """ln of the gamma function for z > 0: Stirling's series at z + 8, brought back by the recurrence."""

    def body(v: Column) -> Column:
        z = v["z"]
        w = z + 8
        down = z
        for i in range(1, 8):
            down = down * (z + i)
        inv = 1 / w
        series = F.lit(0.0)
        for coefficient in reversed(STIRLING):
            series = series * (inv * inv) + F.lit(coefficient)
        return (w - 0.5) * F.ln(w) - w + F.lit(0.5 * math.log(2 * math.pi)) + series * inv - F.ln(down)

    return let(body, z=z)


def ln_choose(n: Column | str, k: Column | str) -> Column:
    n, k = _col(n), _col(k)
    return ln_gamma(n + 1) - ln_gamma(k + 1) - ln_gamma(n - k + 1)


def t_two_sided(t: Column | str, df: Column | str | float) -> Column:
    """P(|T| >= |t|) for a whole number of degrees of freedom.

    Central t: the finite trigonometric sum, about df / 2 terms. Far t, where that sum cancels: the power
    series in df / (df + t^2), whose terms shrink at least by half.
    """

    def central(v: Column) -> Column:
        even = v["df"] % 2 == 0
        odd = F.when(even, 0.0).otherwise(1.0)
        steps = F.floor((v["df"] - 2) / 2)
        start = F.when(even, F.sqrt(1 - v["x"])).otherwise(F.sqrt(1 - v["x"]) * F.sqrt(v["x"]))
        total = _sum_terms(1, steps, start, lambda j: (2 * j - 1 + odd) / (2 * j + odd) * v["x"])
        total = F.when(v["df"] == 1, F.lit(0.0)).otherwise(total)
        return F.greatest(
            F.lit(0.0),
            F.when(even, 1 - total).otherwise(1 - F.lit(2 / math.pi) * (F.atan2(F.abs(v["t"]), F.sqrt(v["df"])) + total)),
        )

    def far(v: Column) -> Column:
        a = v["df"] / 2
        front = F.exp(a * F.ln(v["x"]) + ln_gamma(a + 0.5) - ln_gamma(a + 1)) * F.sqrt(1 - v["x"]) / math.sqrt(math.pi)
        return _sum_terms(1, 60, front, lambda j: (a + j - 0.5) / (a + j) * v["x"])

    def pick(v: Column) -> Column:
        return (
            F.when(F.isnan(v["t"]) | (v["df"] < 1), F.lit(None).cast("double"))
            .when(v["x"] <= 0, F.lit(0.0))
            .when(v["x"] < 0.5, far(v))
            .otherwise(central(v))
        )

    def with_x(v: Column) -> Column:
        return let(pick, t=v["t"], df=v["df"], x=v["df"] / (v["df"] + v["t"] * v["t"]))

    return let(with_x, t=t, df=df)


def f_upper(f: Column | str, d1: Column | str | float, d2: Column | str | float) -> Column:
    """P(F >= f) for whole degrees of freedom: about d1 / 2 terms on top of zero (even d1) or a t tail (odd)."""

    def body(v: Column) -> Column:
        odd = v["d1"] % 2 == 1
        a = v["d2"] / 2
        b0 = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
        base = F.when(odd, t_two_sided(F.sqrt(v["d1"] * v["f"]), v["d2"])).otherwise(F.lit(0.0))
        # terms x^a (1 - x)^b gamma(a + b) / (gamma(a) gamma(b + 1)) for b = b0, b0 + 1, … below d1 / 2
        front = F.exp(
            a * F.ln(v["x"])
            + F.when(odd, 0.5 * F.ln(1 - v["x"]) + ln_gamma(a + 0.5) - ln_gamma(a) - ln_gamma(F.lit(1.5))).otherwise(F.lit(0.0))
        )
        steps = F.floor((v["d1"] - F.when(odd, 3).otherwise(2)) / 2)
        more = _sum_terms(1, steps, front, lambda j: (1 - v["x"]) * (a + b0 + j - 1) / (b0 + j))
        tail = base + F.when(v["d1"] == 1, F.lit(0.0)).otherwise(more)
        return F.when(v["f"] <= 0, F.lit(1.0)).when(v["x"] <= 0, F.lit(0.0)).otherwise(F.least(tail, F.lit(1.0)))

    def with_x(v: Column) -> Column:
        return let(body, f=v["f"], d1=v["d1"], d2=v["d2"], x=v["d2"] / (v["d2"] + v["d1"] * v["f"]))

    return let(with_x, f=f, d1=d1, d2=d2)


def normal_two_sided(z: Column | str) -> Column:
    """P(|Z| >= |z|): the error-function series near zero, its continued fraction in the tail."""

    def body(v: Column) -> Column:
        x = v["x"]
        near = _sum_terms(1, 60, x, lambda j: 2 * x * x / (2 * j + 1))
        fraction = F.aggregate(F.sequence(F.lit(60), F.lit(1), F.lit(-1)), x, lambda acc, j: x + (j / 2) / acc)
        gauss = F.exp(-x * x) / math.sqrt(math.pi)
        return F.when(x < 2, 1 - 2 * gauss * near).otherwise(gauss / fraction)

    return let(body, x=F.abs(_col(z).cast("double")) / math.sqrt(2))


def hypergeom_upper(k: Column | str, drawn: Column | str, marked: Column | str, total: Column | str) -> Column:
    """P(X >= k) when ``drawn`` items are taken from ``total`` of which ``marked`` are marked."""

    def body(v: Column) -> Column:
        k, n, m, total = v["k"], v["n"], v["m"], v["total"]
        start = F.exp(ln_choose(m, k) + ln_choose(total - m, n - k) - ln_choose(total, n))
        tail = _sum_terms(
            0, F.least(m, n) - k - 1, start, lambda j: (m - k - j) * (n - k - j) / ((k + j + 1) * (total - m - n + k + j + 1))
        )
        return F.when(k <= F.greatest(n + m - total, F.lit(0.0)), F.lit(1.0)).when(k > F.least(m, n), F.lit(0.0)).otherwise(
            F.least(tail, F.lit(1.0))
        )

    return let(body, k=k, n=drawn, m=marked, total=total)
