"""Deterministic hashing: salted split, bucket ids and seeded uniforms.

All built from ``md5`` so that any SQL engine with md5 reproduces them
bit for bit.  md5 is read as a 128-bit big-endian integer; it is reduced
modulo ``n`` by folding four 32-bit chunks (Horner's rule mod n), so no
128-bit arithmetic is needed.  Valid for n < 2**31.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = float(2 ** 52)


def md5_mod_sql(text_sql: str, n: int) -> str:
    """SQL text of ``int(md5(text), 16) % n`` (one expression, parsed once)."""
    if not 1 <= n < 2 ** 31:
        raise ValueError("n must be in [1, 2**31)")
    h = f"md5({text_sql})"
    base = (2 ** 32) % n
    r = "CAST(0 AS BIGINT)"
    for i in range(4):
        chunk = f"CAST(conv(substring({h}, {8 * i + 1}, 8), 16, 10) AS BIGINT)"
        r = f"pmod({r} * {base}L + {chunk}, {n}L)"
    return r


def md5_mod(text: Column, n: int) -> Column:
    """``int(md5(text), 16) % n`` for an arbitrary Column."""
    h = F.md5(text)
    base = F.lit((2 ** 32) % n).cast("long")
    nn = F.lit(n).cast("long")
    r = F.lit(0).cast("long")
    for i in range(4):
        chunk = F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long")
        r = F.pmod(r * base + chunk, nn)
    return r


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ab_split(user_id: Column | str, salt: str | None = "exp_mess_1", n_groups: int = 5) -> Column:
    """Group of a user: md5 of ``"<id>-<salt>"`` as an integer, mod ``n_groups``.

    With ``salt=None`` the plain id text is hashed (hash buckets).
    """
    if isinstance(user_id, str):
        uid = f"CAST({_quote(user_id)} AS STRING)"
        if salt is not None:
            uid = "concat(" + uid + ", '-" + salt.replace("'", "\\'") + "')"
        return F.expr(f"CAST({md5_mod_sql(uid, n_groups)} AS INT)")
    text = user_id.cast("string") if salt is None else F.concat(user_id.cast("string"), F.lit(f"-{salt}"))
    return md5_mod(text, n_groups).cast("int")


def uniform01(*parts) -> Column:
    """Seeded uniform in [0, 1): top 52 bits of md5("p1-p2-...")."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    h = F.md5(F.concat_ws("-", *[c.cast("string") for c in cols]))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long").cast("double") / F.lit(TWO_POW_52)


# xxHash64's published primes (fixed values)
XXH_PRIME_1 = 0x9E3779B185EBCA87
XXH_PRIME_2 = 0xC2B2AE3D27D4EB4F
XXH_PRIME_4 = 0x85EBCA77C2B2AE63
XXH_PRIME_5 = 0x27D4EB2F165667C5

#: The seed that Spark's ``xxhash64`` starts from.
SPARK_SEED = 42


def _long_with_hash_zero() -> int:
    """The long whose hash under ``SPARK_SEED`` is 0.

    Spark hashes several columns in a chain, each column's hash being the next
    one's seed, so this value in front gives the next column the seed 0.  The hash
    of 8 bytes is a bijection; it is undone step by step from 0, which the last
    mixing leaves as it is."""
    size = 1 << 64

    def undo(x: int, prime: int) -> int:
        return x * pow(prime, -1, size) % size

    def rotate_right(x: int, bits: int) -> int:
        return (x >> bits | x << (64 - bits)) % size

    mixed = rotate_right(undo(-XXH_PRIME_4 % size, XXH_PRIME_1), 27)
    lane = mixed ^ (SPARK_SEED + XXH_PRIME_5 + 8) % size
    value = undo(rotate_right(undo(lane, XXH_PRIME_1), 31), XXH_PRIME_2)
    return value - size if value >= size // 2 else value


def xxh64(value: Column | str) -> Column:
    """xxHash64 with seed 0, as a signed long: of a long's 8 or an int's 4
    little-endian bytes, or of a string's UTF-8 bytes.  Null for null."""
    c = F.col(value) if isinstance(value, str) else value
    return F.when(c.isNotNull(), F.xxhash64(F.lit(_long_with_hash_zero()).cast("long"), c))


def unsigned_mod(h: Column, n: int) -> Column:
    """``h`` read as an unsigned 64-bit integer, mod ``n`` (below 2**31)."""
    if not 1 <= n < 2 ** 31:
        raise ValueError("n must be in [1, 2**31)")
    m = F.lit(n).cast("long")
    wrap = F.when(h < 0, F.lit((1 << 64) % n)).otherwise(F.lit(0))
    return F.pmod(F.pmod(h, m) + wrap, m)


def hash_bucket(user_id: Column | str, n: int, method: str = "md5") -> Column:
    """Bucket id in [0, n): ``md5`` (portable), ``xxh64`` (published xxHash64, seed 0,
    as column stores bucket) or Spark's native ``xxhash64`` (its own seed).  A null id
    has a null bucket under ``md5`` and ``xxh64``."""
    uid = F.col(user_id) if isinstance(user_id, str) else user_id
    if method == "md5":
        return ab_split(uid, salt=None, n_groups=n)
    if method == "xxh64":
        return unsigned_mod(xxh64(uid), n).cast("int")
    if method == "xxhash64":
        return F.pmod(F.xxhash64(uid), F.lit(n)).cast("int")
    raise ValueError(f"unknown bucket method {method!r}")
