import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.llm import turn_repair

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                      T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                      T.StructField("cost", T.LongType()), T.StructField("conv", T.StringType()),
                      T.StructField("seq", T.StringType()), T.StructField("n", T.LongType())])
SPACE = " \t\n\x0b\x0c\r"


def cheapest(roles, fault):
    """(cost, audit): whole strings for every state, inserts wherever they may be."""
    def inserts(layer):
        grew = True
        while grew:
            grew = False
            for q, (c, s) in list(layer.items()):
                to = "a" if q == "u" else "u"
                if to not in layer or (c + 3, s + "I") < layer[to]:
                    layer[to], grew = (c + 3, s + "I"), True
        return layer

    layer = inserts({"": (0, "")})
    for r, f in zip(roles, fault):
        new = {}

        def offer(q, cost, audit):
            new[q] = min(new.get(q, (cost, audit)), (cost, audit))
        for q, (c, s) in layer.items():
            offer(q, c + 4, s + "D")
            if f not in "bd" or not f:
                e = c + 3 * (f == "t")
                if r[:1] == "s" and q == "":
                    offer("s", e, s + "K")
                to = "a" if q == "u" else "u"
                if r[:1] == to:
                    offer(to, e, s + "K")
                offer(to, e + 3, s + "R")
        layer = inserts(new)
    return min(v for q, v in layer.items() if q in ("", "a"))


def brute(rows):
    """A row of the result for each conv_id, from (conv_id, turn, role, text)."""
    out = {}
    show = lambda x: " " if x is None else str(x)
    for conv in {r[0] for r in rows}:
        own = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            h = zlib.crc32(f"{show(c)}:{show(turn)}".encode()) % 20
            role, text = show(role), show(text)
            if h == 1:
                text = ""
            if h == 2:
                text = "".join(x for x in text if x not in ".!?")
            if h == 4:
                role = "user"
            own += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, fault = set(), []
        for _, role, text in own:
            body = text.rstrip(SPACE)
            fault.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        roles = [r for _, r, _ in own]
        cost, audit = cheapest(roles, fault)
        lines, state, i = [], "", 0
        for x in audit:
            to = "a" if state == "u" else "u"
            if x == "K" and state == "" and roles[i][:1] == "s":
                to = "s"
            if x != "D":
                state = to
                name = {"u": "user", "a": "assistant"}.get(to)
                lines.append(f"{name}:" if x == "I" else f"{name if x == 'R' else roles[i]}:{own[i][2]}")
            i += x != "I"
        turns = {t for t, _, _ in own if t is not None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(fault.count(f) for f in "bdt"),
                     sum((a[:1], b[:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(roles, roles[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, None, "x", "y", 1) for r in rows], TURNS).repartition(parts)


def found(spark, turns, **options):
    done = turn_repair.digests(turn_repair.repair(turn_repair.damaged(turns), **options), turns)
    rows = done.collect()
    out = {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                              "repaired_sha256")) for r in rows}
    assert len(out) == len(rows)
    return out


def odd_rows(seed, n):
    rnd = random.Random(seed)
    says = ["Yes.", "No!", "what", "", " ", "\t\n", "Why? \n", "a:b", "end.", "é…", None, "x" * 40 + ".", "No. 1"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "usher", "User"]
    return [(rnd.choice([1, 2, 2, 2, 3, 4, None, 7, 8, 9]), rnd.choice([None, *range(12)]), rnd.choice(roles), rnd.choice(says))
            for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"block_rows": 3}, {"block_bytes": 60}])
def test_op13_equals_brute_force(spark, options):
    rows = odd_rows(1, 260) + [(50, i, "user" if i % 3 else "assistant", f"say {i % 7}.") for i in range(60)]
    rows += [(60, 1, "user", "again.")] * 25 + [(61, 0, "system", "only.")] + [(62, None, None, None)]
    rows += [(63, (1 << 62), "user", "far."), (63, -(1 << 62), "user", "near."), (64, 5, "user", "w " * 700 + ".")]
    assert found(spark, frame(spark, rows), **options) == brute(rows)


def test_op13_given_conversations(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert found(spark, turns) == brute([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])


def test_op13_one_long_conversation(spark):
    """One conversation in many blocks and tasks."""
    rnd = random.Random(9)
    rows = [(1, i, rnd.choice(["user", "assistant", "assistant", "system"]), f"{rnd.randrange(900)}{rnd.choice('.!x')}")
            for i in range(3000)]
    turns = frame(spark, rows, 8)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        check_long(spark, turns, rows)
    finally:
        spark.conf.set(setting, "true")


def check_long(spark, turns, rows):
    assert found(spark, turns, block_rows=50) == brute(rows)
    blocks = turn_repair.blocks_of(turn_repair.damaged(turns).select(
        F.col("conv_id").cast("string").alias("conv"), "turn", "role", "text", F.lit(1).cast("long").alias("n")), 50, 10 ** 6)
    per = blocks.groupBy("part").agg(F.sum(F.size("texts")).alias("n")).collect()
    assert len(per) >= 4 and max(r["n"] for r in per) < 1500


def test_op13_no_rows(spark):
    none = frame(spark, []).limit(0)
    assert found(spark, none) == {}
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert found(spark, frame(spark, [(gone, 0, "user", "hi.")])) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_programme_equals_whole_strings():
    rnd = random.Random(3)
    for _ in range(2000):
        n = rnd.randint(1, 9)
        roles = [rnd.choice(["system", "user", "assistant", "tool", ""]) for _ in range(n)]
        fault = [rnd.choice(["", "", "", "b", "d", "t", "t"]) for _ in range(n)]
        cost, node, _, tail = turn_repair.finish(turn_repair.programme(roles, fault, turn_repair.NONE))
        assert (cost, turn_repair.letters_of(node) + "I" * tail) == cheapest(roles, fault)


@pytest.mark.parametrize("prime", [turn_repair.PRIME, 2])
def test_strings_as_nodes_compare_as_strings(monkeypatch, prime):
    """With a hash of two values equal hashes prove nothing, and letters decide."""
    monkeypatch.setattr(turn_repair, "PRIME", prime)
    rnd = random.Random(5)
    nodes = []
    for _ in range(300):
        text, node = rnd.choice(nodes) if nodes and rnd.random() < 0.7 else ("", None)
        for _ in range(rnd.randint(1, 40)):
            x = rnd.choice("DIKR") if rnd.random() < 0.2 else "K"
            text, node = text + x, turn_repair.Node(node, x, 0)
        nodes.append((text, node))
    for _ in range(3000):
        (a, x), (b, y) = rnd.choice(nodes), rnd.choice(nodes)
        assert turn_repair.less(x, y) == (a < b)
        assert x.at_depth(rnd.randint(1, len(a))).depth <= len(a) and turn_repair.letters_of(x) == a
