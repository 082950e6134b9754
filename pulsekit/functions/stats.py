"""Distribution tails, Welch columns and random weights.

All are native Column expressions; no Python runs in a task.

The tail of a density f beyond x is written over w = -log(f(u) / f(0)): its fall by
exp(-w(x)) stands before the integral, so that small p-values keep their relative
accuracy, and what stays is K(w(x)) = integral over s >= 0 of exp(-s) / slope, with a root
singularity at w = 0 only.  K(0) is the half of the whole, so K(w) / K(0) needs no
normalising constant.

* Student t, two-sided, w = (df + 1) / 2 * log(1 + u^2 / df):
  p = (1 + t^2 / df)^(-df / 2) * K(w) / K(0),
  K(w) = integral of exp(-s * df / (df + 1)) / sqrt(1 - exp(-2 * (w + s) / (df + 1))).
* Normal, two-sided, w = z^2 / 2: p = exp(-w) * K(w) / sqrt(pi),
  K(w) = integral of exp(-s) / sqrt(w + s).

K is a sum over the fixed nodes s = exp(pi / 2 * sinh(k * STEP)) (the double-exponential
rule for a half line): some 140 terms of a higher-order ``aggregate`` for each test.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spacing of the nodes, and where they begin and end: s from 1e-29 to 2e3.
STEP, FIRST, LAST = 0.05, -4.45, 2.3


def _nodes() -> str:
    """The nodes and their weights as an array of (s, weight), in SQL."""
    out = []
    for k in range(round(FIRST / STEP), round(LAST / STEP) + 1):
        y = k * STEP
        s = math.exp(math.pi / 2 * math.sinh(y))
        out.append(f"struct({s!r}D AS s, {STEP * math.pi / 2 * math.cosh(y) * s!r}D AS weight)")
    return f"array({', '.join(out)})"


def _half_line(term) -> Column:
    """Sum of weight * term(s) over the nodes."""
    return F.aggregate(F.expr(_nodes()), F.lit(0.0), lambda acc, n: acc + n["weight"] * term(n["s"]))


def t_two_sided_p(t: Column, df: Column) -> Column:
    """Two-sided p-value of Student's t with (possibly fractional) ``df``; null where
    one of them is null or NaN or df is not positive.  Relative error below 1e-10 for
    df of 1 and more, however small p is."""
    t, df = t.cast("double"), df.cast("double")
    log1p = F.log1p(t * t / df)
    w = (df + F.lit(1.0)) / F.lit(2.0) * log1p

    def k(w: Column) -> Column:
        return _half_line(lambda s: F.exp(-s * df / (df + F.lit(1.0)))
                          / F.sqrt(-F.expm1(F.lit(-2.0) * (w + s) / (df + F.lit(1.0)))))

    valid = t.isNotNull() & df.isNotNull() & ~F.isnan(t) & ~F.isnan(df) & (df > 0)
    p = F.exp(-df / F.lit(2.0) * log1p) * k(w) / k(F.lit(0.0))
    return F.when(valid, F.least(p, F.lit(1.0)))


def normal_two_sided_p(z: Column) -> Column:
    """min(1, 2 * P(Z > z)) for the standard normal; for z < 0 the doubled
    tail exceeds 1 and is clipped, as SciPy does.  Null where z is null or NaN."""
    z = z.cast("double")
    w = z * z / F.lit(2.0)
    p = F.exp(-w) * _half_line(lambda s: F.exp(-s) / F.sqrt(w + s)) / F.lit(math.sqrt(math.pi))
    return (F.when(z.isNull() | F.isnan(z), F.lit(None).cast("double"))
            .when(z <= 0, F.lit(1.0)).otherwise(F.least(p, F.lit(1.0))))


def welch_columns(n1: Column, m1: Column, v1: Column,
                  n2: Column, m2: Column, v2: Column) -> dict[str, Column]:
    """t, df and two-sided p of Welch's unequal-variance t-test."""
    a = v1 / n1
    b = v2 / n2
    se2 = a + b
    ok = (n1 >= 2) & (n2 >= 2) & (se2 > 0)
    t = F.when(ok, (m1 - m2) / F.sqrt(se2))
    dof = F.when(ok, se2 * se2 / (a * a / (n1 - F.lit(1.0)) + b * b / (n2 - F.lit(1.0))))
    return {"t_stat": t, "dof": dof, "p_value": t_two_sided_p(t, dof)}


def poisson_cdf_table(mean: float = 1.0) -> list[float]:
    """P(X <= k) for X ~ Poisson(mean), k = 0.. until it rounds to 1.0 or stops
    growing.

    Beyond the last entry the CDF equals 1.0 to the last digits, so the
    inverse-CDF weight below is exact for every representable uniform.
    """
    out, term, acc, k = [], math.exp(-mean), 0.0, 0
    while acc + term < 1.0 and (k <= mean or acc + term > acc):
        acc += term
        out.append(acc)
        k += 1
        term *= mean / k
    return out


def count_bounds_below(x: Column, bounds: list[float], inclusive: bool = False) -> Column:
    """Number of sorted ``bounds`` below ``x`` (``<=`` when inclusive), as a
    balanced CASE tree: log2(len) comparisons, fully code-generated."""
    def rec(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        b = F.lit(float(bounds[mid]))
        below = (b <= x) if inclusive else (b < x)
        return F.when(below, rec(mid + 1, hi)).otherwise(rec(lo, mid))
    return rec(0, len(bounds))


def count_bounds_below_sql(x_sql: str, bounds: list[float], inclusive: bool = False) -> str:
    """SQL text of ``count_bounds_below`` (one expression, parsed once on the
    JVM instead of being assembled call by call)."""
    op = "<=" if inclusive else "<"

    def rec(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        b = f"CAST('{float(bounds[mid])!r}' AS DOUBLE)"
        return f"CASE WHEN {b} {op} {x_sql} THEN {rec(mid + 1, hi)} ELSE {rec(lo, mid)} END"
    return rec(0, len(bounds))


def poisson_draw(u: Column, mean: float) -> Column:
    """Poisson(mean) draw by inverse CDF: number of CDF points <= u."""
    return count_bounds_below(u, poisson_cdf_table(mean), inclusive=True).cast("long")
