"""Poisson(m) draws for any whole m, as Column expressions over seeded uniforms.

Below ``SMALL`` m is the sum of its powers of two, each drawn by inverse CDF from
a table of a few dozen numbers.  From ``SMALL`` on a draw is made by transformed
rejection (Hoermann's PTRS): a proposal from a table-mountain hat, accepted at once
in four of five cases, else against the exact probability.  So a draw takes at most
four uniforms, or a pair of them for each of a few attempts, whatever m is.

The logarithm of the probability is written by the deviance of k from m, which
keeps its digits for m of 1e9, where the terms of the plain formula cancel.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsekit.functions.stats import count_bounds_below_sql, poisson_cdf_table

#: Means from here on are drawn by rejection.
SMALL = 16
POWERS = (0, 1, 2, 3)
#: A draw fails to accept in so many attempts once in about 1e21 cases, and raises.
ATTEMPTS = 32


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def num(x: float) -> str:
    return f"{x!r}D"


def bound_sql(name: str, value: str, use: str) -> str:
    """``use``, where ``name`` stands for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {use}), 1)"


def log_probability_sql(k: str, m: str) -> str:
    """ln P(X = k) for X ~ Poisson(m); k a whole double >= 0, m a double."""
    x = f"(({k} - {m}) / {m})"
    deviance = f"({m} * ((1.0D + {x}) * log1p({x}) - {x}))"
    rest = f"(({num(1 / 12)} - ({num(1 / 360)} - ({num(1 / 1260)} - {num(1 / 1680)} / ({k} * {k})) / ({k} * {k})) / ({k} * {k})) / {k})"
    return (f"CASE WHEN {k} < 10 THEN {k} * ln({m}) - {m} - ln(CAST(factorial(CAST({k} AS INT)) AS DOUBLE)) "
            f"ELSE -{deviance} - 0.5D * ln({num(2 * math.pi)} * {k}) - {rest} END")


def poisson_large_sql(mean: str, key: list[str]) -> str:
    """A Poisson(mean) draw for a mean of at least ten, a function of the columns
    ``key``: attempt j has the uniforms in the first 104 bits of md5("key-..-j")."""
    m = f"CAST({mean} AS DOUBLE)"
    b = f"(0.931D + 2.53D * sqrt({m}))"
    a = f"(0.02483D * {b} - 0.059D)"
    hat = f"ln(1.1239D + 1.1328D / ({b} - 3.4D))"
    sure = f"(0.9277D - 3.6224D / ({b} - 2.0D))"

    def uniform(at: int) -> str:
        return f"CAST(CAST(conv(substring(h, {at}, 13), 16, 10) AS BIGINT) AS DOUBLE) / {num(float(2 ** 52))}"

    judged = (f"CASE WHEN q.s >= 0.07D AND q.v <= {sure} THEN CAST(q.k AS BIGINT) "
              "WHEN q.k < 0 OR (q.s < 0.013D AND q.v > q.s) THEN CAST(NULL AS BIGINT) "
              f"WHEN ln(q.v) + {hat} - ln(try_divide({a}, q.s * q.s) + {b}) <= {log_probability_sql('q.k', m)} "
              "THEN CAST(q.k AS BIGINT) END")
    # s is 0 once in 2^52 pairs, which is no proposal
    proposed = bound_sql("q", f"named_struct('s', 0.5D - abs(p.u), 'v', p.v, 'k', CAST(floor("
                              f"(2.0D * try_divide({a}, 0.5D - abs(p.u)) + {b}) * p.u + {m} + 0.43D) AS DOUBLE))", judged)
    pair = bound_sql("p", f"named_struct('u', {uniform(1)} - 0.5D, 'v', {uniform(14)})", proposed)
    attempt = bound_sql("h", f"md5(concat_ws('-', {', '.join(key)}, j))", pair)
    found = (f"aggregate(sequence(0, {ATTEMPTS - 1}), CAST(NULL AS BIGINT), (got, j) -> coalesce(got, {attempt}))")
    return f"coalesce({found}, CAST(raise_error('a Poisson draw accepted none of its attempts') AS BIGINT))"


def parts_of(m: str) -> Column:
    """What a draw for m users is made of: powers of two below SMALL, or -1 for one
    draw by rejection."""
    m = quoted(m)
    bits = ", ".join(f"CASE WHEN {m} & {1 << b} <> 0 THEN {b} END" for b in POWERS)
    return F.expr(f"CASE WHEN {m} < {SMALL} THEN array_compact(array({bits})) ELSE array(-1) END")


def poisson_part(part: str, m: str, u: str, key: list[str]) -> Column:
    """The draw of one part, of columns by name: ``u`` is the uniform of a power of
    two, ``key`` gives those of the attempts.  One expression, parsed once."""
    part, m, u = quoted(part), quoted(m), quoted(u)
    tables = " ".join(f"WHEN {part} = {b} THEN CAST({count_bounds_below_sql(u, poisson_cdf_table(float(1 << b)), True)} AS BIGINT)"
                      for b in POWERS)
    return F.expr(f"CASE {tables} ELSE {poisson_large_sql(m, key)} END")
