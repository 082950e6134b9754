"""A keyed permutation of 0 .. n-1 in Column arithmetic.

A Feistel network over pairs (left, right) of 0 .. a-1 and 0 .. b-1, with a the
rounded-up root of n and b = n / a rounded up, permutes the numbers below a * b, fewer
than a of which are n or more.  Rounds change left and right by turns: to one half a
function of the other and of the round's key is added.  A result of n or more is
permuted again (cycle walking) until it is below n: a rare step, and at most a of them
follow each other.  So the images of 0 .. k-1 are k distinct numbers, a sample
without replacement that needs no candidates, no distinct and no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: The rounds' arithmetic is modulo this prime; its squares fit a long.
PRIME = 2147483647
FACTOR = 40503
#: Steps of a cycle walk.  A step is needed with a probability under 1 / b, and never
#: more than a in a row, so that this many are needed once in far more than 1e24 cases.
STEPS = 24


def round_keys(*parts) -> list[Column]:
    """ROUNDS numbers below 2^32 from md5 of "p1-p2-..-0" and "..-1"."""
    out = []
    for half in (0, 1):
        h = F.md5(F.concat_ws("-", *[(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts], F.lit(str(half))))
        out += [F.conv(F.substring(h, at, 8), 16, 10).cast("long") for at in (1, 9, 17, 25)]
    return out


def mixed(half: str, key: str) -> str:
    once = f"(({half} * {FACTOR}L + {key}) % {PRIME}L)"
    return f"(({once} * {once} + {key}) % {PRIME}L)"


def with_permuted(df: DataFrame, x: str, n: str, keys: list[str], name: str) -> DataFrame:
    """``df`` with the image of column ``x`` under the permutation of 0 .. n-1 that
    the columns ``keys`` (of ``round_keys``) give."""
    a, b, left, right, once = (f"_perm_{c}" for c in ("a", "b", "l", "r", "y"))
    kept = [c for c in df.columns if c != name]
    d = df.withColumn(a, F.ceil(F.sqrt(F.col(n).cast("double"))).cast("long"))
    d = d.withColumn(b, F.expr(f"({n} + {a} - 1) div {a}"))
    d = d.withColumn(left, F.expr(f"{x} div {b}")).withColumn(right, F.expr(f"{x} % {b}"))
    for r, key in enumerate(keys):
        own, other, size = (left, right, a) if r % 2 == 0 else (right, left, b)
        d = d.withColumn(own, F.expr(f"({own} + {mixed(other, key)}) % {size}"))
    d = d.withColumn(once, F.expr(f"{left} * {b} + {right}"))
    # the same rounds inside a walk, for the few that are not below n yet
    step = f"named_struct('l', y div {b}, 'r', y % {b})"
    for r, key in enumerate(keys):
        s, to = f"s{r}", (f"named_struct('l', (s{r}.l + {mixed(f's{r}.r', key)}) % {a}, 'r', s{r}.r)" if r % 2 == 0 else
                          f"named_struct('l', s{r}.l, 'r', (s{r}.r + {mixed(f's{r}.l', key)}) % {b})")
        step = f"element_at(transform(array({step}), {s} -> {to}), 1)"
    step = f"element_at(transform(array({step}), t -> t.l * {b} + t.r), 1)"
    walk = f"aggregate(sequence(1, {STEPS}), {once}, (y, i) -> CASE WHEN y < {n} THEN y ELSE {step} END)"
    checked = (f"element_at(transform(array({walk}), y -> CASE WHEN y < {n} THEN y ELSE "
               f"CAST(raise_error('a permutation did not come back below n') AS BIGINT) END), 1)")
    # never null, and said so: a join by the result would else push a null test of it
    # below the rounds, with all of them written out in it
    return d.select(*kept, F.coalesce(F.expr(f"CASE WHEN {once} < {n} THEN {once} ELSE {checked} END"), F.lit(-1).cast("long")).alias(name))
