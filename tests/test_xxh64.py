"""xxHash64 with seed 0 against the published vectors and the xxhash library."""

import struct

import pytest
from pyspark.sql import functions as F

from pulsekit.functions.hashing import hash_bucket, unsigned_mod, xxh64

xxhash = pytest.importorskip("xxhash")

IDS = [0, 1, -1, 42, 50, 2 ** 31, -2 ** 31, 2 ** 63 - 1, -2 ** 63, *range(1000, 1200)]


def test_published_vectors(spark):
    rows = spark.createDataFrame([("",), ("a",), ("abc",)], "s string")
    got = {r.s: r.h % 2 ** 64 for r in rows.select("s", xxh64("s").alias("h")).collect()}
    assert got == {"": 0xEF46DB3751D8E999, "a": 0xD24EC4F1A98C6E5B, "abc": 0x44BC2CF5AD770999}


def test_longs_and_ints_hash_as_their_bytes(spark):
    rows = spark.createDataFrame([(i,) for i in IDS], "id long")
    for r in rows.select("id", xxh64("id").alias("h"), hash_bucket("id", 50, "xxh64").alias("b")).collect():
        want = xxhash.xxh64_intdigest(struct.pack("<q", r.id), seed=0)
        assert (r.h % 2 ** 64, r.b) == (want, want % 50)
    ints = rows.where(F.col("id").between(-2 ** 31, 2 ** 31 - 1)).select(F.col("id").cast("int").alias("id"))
    for r in ints.select("id", xxh64("id").alias("h")).collect():
        assert r.h % 2 ** 64 == xxhash.xxh64_intdigest(struct.pack("<i", r.id), seed=0)


def test_null_has_no_bucket(spark):
    row = spark.createDataFrame([(None,)], "id long").select(hash_bucket("id", 50, "xxh64").alias("b")).first()
    assert row.b is None


@pytest.mark.parametrize("n", [1, 2, 50, 97, 2 ** 31 - 1])
def test_unsigned_mod(spark, n):
    rows = spark.createDataFrame([(i,) for i in IDS], "id long")
    for r in rows.select("id", unsigned_mod(F.col("id"), n).alias("m")).collect():
        assert r.m == r.id % 2 ** 64 % n
