"""Independent DuckDB SQL for every registered query (the correctness gate).

Only the base ``events`` table is registered by the checker, so each
statement starts with the fixture views of FIXTURES.md.  Snippet builders
below emit the same arithmetic the Spark side uses (md5 folding, seeded
uniforms, half-even rounding, Simpson tails), written in plain SQL.
"""

from __future__ import annotations

import math

# The oracle's own settings.  Tails are integrated on a finer grid than the
# operators use, so that the two agree only if both are right.
SIMPSON_STEPS = 3000
NORMAL_SPAN = 13.0


# ----------------------------------------------------------------- snippets
def md5_mod(text: str, n: int) -> str:
    h = f"md5({text})"
    b = (2 ** 32) % n
    r = "0"
    for i in range(4):
        chunk = f"('0x' || substr({h}, {8 * i + 1}, 8))::BIGINT"
        r = f"(({r}) * {b} + {chunk}) % {n}"
    return r


def split(uid: str, salt: str | None, n: int) -> str:
    text = f"CAST({uid} AS VARCHAR)" if salt is None else f"(CAST({uid} AS VARCHAR) || '-{salt}')"
    return f"CAST({md5_mod(text, n)} AS INTEGER)"


def xxh64_of_longs(src: str, col: str) -> str:
    """SELECT of ``col`` and ``h``: xxHash64 (seed 0) of its 8 bytes as UBIGINT, in
    128-bit arithmetic reduced modulo 2**64."""
    p1, p2, p3 = 11400714785074694791, 14029467366897019727, 1609587929392839161
    p4, p5 = 9650029242287828579, 2870177450012600261

    def low(e: str) -> str:
        return f"CAST(({e}) % 18446744073709551616::UHUGEINT AS UBIGINT)"

    def times(x: str, k: int) -> str:
        return low(f"CAST({x} AS UHUGEINT) * {k}::UHUGEINT")

    def rotl(x: str, r: int) -> str:
        return f"({times(x, 2 ** r)} | ({x} >> {64 - r}))"

    unsigned = low(f"CAST(CASE WHEN {col} < 0 THEN {col}::HUGEINT + 18446744073709551616::HUGEINT ELSE {col} END AS UHUGEINT)")
    steps = [times("x", p2), times(rotl("x", 31), p1), f"xor(x, {p5 + 8}::UBIGINT)",
             low(f"CAST({times(rotl('x', 27), p1)} AS UHUGEINT) + {p4}::UHUGEINT"),
             times("xor(x, x >> 33)", p2), times("xor(x, x >> 29)", p3), "xor(x, x >> 32)"]
    q = f"SELECT DISTINCT {col}, {unsigned} AS x FROM {src}"
    for step in steps:
        q = f"SELECT {col}, {step} AS x FROM ({q})"
    return f"SELECT {col}, x AS h FROM ({q})"


def uniform(*parts: str) -> str:
    h = f"md5(concat_ws('-', {', '.join(parts)}))"
    return f"(CAST(('0x' || substr({h}, 1, 13))::BIGINT AS DOUBLE) / {float(2 ** 52)!r})"


def rnd(expr: str, digits: int) -> str:
    """Half-even on the scaled value; ``+ 0.0`` turns a -0.0 into 0.0."""
    s = float(10 ** digits)
    return f"(round_even(CAST({expr} AS DOUBLE) * {s!r}, 0) / {s!r} + 0.0)"


def r6(expr: str) -> str:
    return rnd(expr, 6)


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def simpson(f, lo: str, hi: str, steps: int = SIMPSON_STEPS) -> str:
    """``f`` maps an SQL expression (the abscissa) to the integrand."""
    h = f"(({hi}) - ({lo})) / {float(steps)!r}"
    w = f"(CASE WHEN i = 0 OR i = {steps} THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END)"
    x = f"(({lo}) + CAST(i AS DOUBLE) * {h})"
    body = f"list_sum(list_transform(range(0, {steps + 1}), lambda i: {w} * {f(x)}))"
    return f"({body} * {h} / 3.0)"


def t_p(t: str, dof: str) -> str:
    at = f"abs({t})"
    sdf = f"sqrt({dof})"
    theta0 = f"atan({at} / {sdf})"
    # from the angle of t to where cos(x) ** (dof - 1) is 1e-35 times smaller
    fall = f"exp(-80.0 / greatest({dof} - 1.0, 1e-9))"
    den_hi, num_hi = f"acos({fall})", f"acos(cos({theta0}) * {fall})"

    def dens(x):
        return f"exp(({dof} - 1.0) * ln(greatest(cos({x}), 1e-300)))"

    p = f"({simpson(dens, theta0, num_hi)} / {simpson(dens, '0.0', den_hi)})"
    return (f"(CASE WHEN {t} IS NULL OR {dof} IS NULL OR {dof} <= 0 THEN NULL "
            f"ELSE least(greatest({p}, 0.0), 1.0) END)")


def norm_p(z: str) -> str:
    def dens(x):
        return f"(exp(-({x}) * ({x}) / 2.0) / {math.sqrt(2.0 * math.pi)!r})"

    tail = simpson(dens, z, f"({z}) + {NORMAL_SPAN!r}")
    return f"(CASE WHEN {z} IS NULL THEN NULL ELSE least(2.0 * {tail}, 1.0) END)"


def poisson(u: str, mean: int) -> str:
    """Draw by inverse CDF, from the probabilities' logarithms."""
    points, total = [], 0.0
    for k in range(mean + 12 * int(math.sqrt(mean)) + 25):
        total = math.fsum([total, math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))])
        points.append(min(total, 1.0))
    table = ", ".join(repr(c) for c in points if c < 1.0)
    return f"CAST(len(list_filter([{table}], lambda c: c <= {u})) AS BIGINT)"


def poisson_any(mean: str, u: str, part: str, *key: str) -> str:
    """A draw of a part: by inverse CDF for a power of two (part >= 0), or for part -1
    by rejection, every attempt listed and the first accepted one taken."""
    m = f"CAST({mean} AS DOUBLE)"
    h = f"md5(concat_ws('-', {', '.join(key)}, j))"
    u1, v = (f"(CAST(('0x' || substr({h}, {at}, 13))::BIGINT AS DOUBLE) / {float(2 ** 52)!r})" for at in (1, 14))
    b = f"(0.931 + 2.53 * sqrt({m}))"
    a = f"(0.02483 * {b} - 0.059)"
    tries = f"""list_transform(list_transform(range(0, 32),
        lambda j: {{'u': {u1} - 0.5, 'v': {v}}}),
        lambda t: {{'s': 0.5 - abs(t.u), 'v': t.v, 'k': floor((2.0 * {a} / (0.5 - abs(t.u)) + {b}) * t.u + {m} + 0.43)}})"""
    good = f"""list_filter({tries}, lambda t: (t.s >= 0.07 AND t.v <= 0.9277 - 3.6224 / ({b} - 2.0))
        OR (t.k >= 0 AND NOT (t.s < 0.013 AND t.v > t.s)
            AND ln(t.v * (1.1239 + 1.1328 / ({b} - 3.4)) / ({a} / (t.s * t.s) + {b}))
                <= t.k * ln({m}) - {m} - lgamma(greatest(t.k, 0.0) + 1.0)))"""
    tables = " ".join(f"WHEN {b} THEN {poisson(u, 2 ** b)}" for b in range(4))
    return f"CASE {part} {tables} ELSE CAST({good}[1].k AS BIGINT) END"


def welch_sql(n1, m1, v1, n2, m2, v2) -> dict[str, str]:
    a, b = f"({v1} / {n1})", f"({v2} / {n2})"
    se2 = f"({a} + {b})"
    ok = f"({n1} >= 2 AND {n2} >= 2 AND {se2} > 0)"
    t = f"(CASE WHEN {ok} THEN ({m1} - {m2}) / sqrt({se2}) END)"
    dof = f"(CASE WHEN {ok} THEN {se2} * {se2} / ({a} * {a} / ({n1} - 1.0) + {b} * {b} / ({n2} - 1.0)) END)"
    return {"t_stat": t, "dof": dof, "p_value": t_p(t, dof)}


# ----------------------------------------------------------------- fixtures
FIXTURE = f"""
feed_actions AS (
    SELECT user_id, ts AS time,
           CASE WHEN event_type = 'click' THEN 'like' ELSE 'view' END AS action,
           CAST(user_id % 2 AS INTEGER) AS gender,
           CAST(15 + (user_id * 7) % 50 AS INTEGER) AS age,
           CASE WHEN user_id % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os,
           {split('user_id', 'exp_mess_1', 5)} AS exp_group
    FROM events WHERE event_type IN ('view', 'click')
),
message_actions AS (
    SELECT user_id, abs(user_id + event_id % 7 - 3) AS receiver_id, ts AS time,
           CAST(user_id % 2 AS INTEGER) AS gender,
           CAST(15 + (user_id * 7) % 50 AS INTEGER) AS age,
           CASE WHEN user_id % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os
    FROM events WHERE event_type IN ('signup', 'purchase')
)"""


def with_fixture(*ctes: str) -> str:
    parts = [FIXTURE] + [c.strip() for c in ctes[:-1]]
    return "WITH " + ",\n".join(parts) + "\n" + ctes[-1]
