"""Operator 13: repair of a conversation's structure at least cost, with an audit.

A conversation's rows are taken by turn (nulls first; ties by role, then text).  The
first fault of a row counts: blank, duplicate (role and text seen earlier) or
truncated (no end mark last).  Edits in order give roles ``(s?(ua)+)?``: Keep (0),
Rerole to user or assistant (3), Delete (4; the only edit of blank and duplicate
rows), Insert an empty user or assistant turn (3, anywhere); a truncated row that
stays adds 3.  Of the cheapest audits, a letter an edit, the ASCII-least is taken.

Dynamic programme over (row, role reached).  The audits of all states share their
prefixes as linked nodes; a node holds its ancestors at distances 1, 2, 4 .. and the
rolling hash of its letters.  Two audits of equal cost are compared by the longest
common prefix, found by lifting both while the hashes differ; equal hashes of two
nodes are verified letter by letter.  Inserts are put right before a row that stays,
or at the end, as an insert before a deleted row is the greater string.

Rows are dealt by ranges of (conversation, turn, role, text), so a long conversation
lies in many tasks; rows alike in all of these are counted before they move.  Blocks
hold at most ``block_rows`` rows.  Nearly all conversations are one block and solved
as such.  For the others the first block of every (role, text) is found by an
aggregate; a block's programme runs from each state it may be entered in, and gives
cost and rank (in ASCII order) of each exit; a programme over blocks with the same
linked nodes, ranks as letters, picks the states; then each block writes its piece.

Null conversation ids are one conversation; null role or text is one space.  Roles
go by their first letter; other letters (or none) can't stay.  A table without rows
gives none; a conversation without rows is the caller's to add.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.session import ship
from pulsekit.llm.common import job_dir, release, written

DELETE, REROLE, INSERT, CUT = 4, 3, 3, 3
SPACE = " \t\n\x0b\x0c\r"
#: Roles reached: none yet, system, user, assistant; what may follow each.
NONE, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAME = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
#: Inserts at the end that complete the roles.
TAIL = {NONE: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}

PRIME = (1 << 61) - 1
RADIX = 1_000_003


class Node:
    """A string by its last letter and the string before; None is the empty one."""

    __slots__ = ("letter", "depth", "hash", "up", "state")

    def __init__(self, parent: "Node | None", letter, state: int):
        self.letter, self.state = letter, state
        code = (letter if isinstance(letter, int) else ord(letter)) + 1
        if parent is None:
            self.depth, self.hash, self.up = 1, code, ()
            return
        self.depth, self.hash = parent.depth + 1, (parent.hash * RADIX + code) % PRIME
        up, i = [parent], 0
        while len(up[i].up) > i:
            up.append(up[i].up[i])
            i += 1
        self.up = tuple(up)

    def at_depth(self, depth: int) -> "Node":
        node = self
        while node.depth > depth:
            far = min(len(node.up), (node.depth - depth).bit_length()) - 1
            node = node.up[far]
        return node

    def chain(self) -> list["Node"]:
        out, node = [], self
        while True:
            out.append(node)
            if not node.up:
                return out[::-1]
            node = node.up[0]


def same(a: Node, b: Node) -> bool:
    """Whether two strings of one length are equal; hashes rule out, letters prove."""
    if a is b:
        return True
    if a.hash != b.hash:
        return False
    while a is not b:
        if a.letter != b.letter:
            return False
        if not a.up:
            return True
        a, b = a.up[0], b.up[0]
    return True


def less(x: Node, y: Node) -> bool:
    """Whether x's string comes before y's; a prefix comes first."""
    a, b = x.at_depth(y.depth), y.at_depth(x.depth)
    if same(a, b):
        return x.depth < y.depth
    for i in range(len(a.up) - 1, -1, -1):
        # both have gone up alike, so that they have as many ancestors
        if i < len(a.up) and not same(a.up[i], b.up[i]):
            a, b = a.up[i], b.up[i]
    return a.letter < b.letter


def faults(roles: list[str], texts: list[str], seen: set) -> list[str]:
    """'b', 'd', 't' or '' for each row; ``seen``: (role, text) of earlier rows."""
    out = []
    for r, t in zip(roles, texts):
        body = t.rstrip(SPACE)
        key = digest(r, t)
        out.append("b" if not body else "d" if key in seen else "t" if body[-1] not in ".!?" else "")
        seen.add(key)
    return out


def digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


def programme(roles: list[str], fault: list[str], entry: int) -> dict[int, tuple[int, Node]]:
    """For each role reached after the rows: least cost and the least such audit."""
    best: dict[int, tuple[int, Node | None]] = {entry: (0, None)}
    for role, f in zip(roles, fault):
        step: dict[int, tuple[int, Node | None, str]] = {}

        def offer(state: int, cost: int, node: Node | None, letters: str) -> None:
            old = step.get(state)
            if old is not None and cost == old[0]:
                if node is old[1]:
                    first = letters < old[2]
                else:            # strings of unlike states differ before they end
                    first = less(node, old[1])
                if not first:
                    return
            elif old is not None and cost > old[0]:
                return
            step[state] = cost, node, letters

        first = role[:1]
        for q, (cost, node) in best.items():
            offer(q, cost + DELETE, node, "D")
            if f in ("b", "d"):
                continue
            extra = cost + (CUT if f == "t" else 0)
            if first == "s" and q == NONE:
                offer(SYSTEM, extra, node, "K")
            for p, more, ins in ((q, 0, ""), (NEXT[q], INSERT, "I")):
                to = NEXT[p]
                if first == ("u" if to == USER else "a"):
                    offer(to, extra + more, node, ins + "K")
                offer(to, extra + more + REROLE, node, ins + "R")
        best = {}
        for state, (cost, node, letters) in step.items():
            for x in letters:
                node = Node(node, x, state)
            best[state] = cost, node
    return best


def finish(best: dict[int, tuple[int, Node]]) -> tuple[int, Node, int, int]:
    """(cost, audit, state, inserts at the end) of the cheapest and least end."""
    ends = sorted(((cost + INSERT * TAIL[s], s) for s, (cost, _) in best.items()))
    chosen = None
    for cost, s in ends:
        if cost == ends[0][0] and (chosen is None or less(best[s][1], best[chosen][1])):
            chosen = s
    return ends[0][0], best[chosen][1], chosen, TAIL[chosen]


def letters_of(node: Node | None) -> str:
    return "".join(n.letter for n in node.chain()) if node else ""


def rewritten(roles: list[str], texts: list[str], audit: str, entry: int) -> list[str]:
    """The repaired rows ``role:text`` that an audit gives."""
    out, state, i = [], entry, 0
    for x in audit:
        if x == "I":
            state = NEXT[state]
            out.append(f"{NAME[state]}:")
            continue
        if x == "K" and state == NONE and roles[i][:1] == "s":
            state = SYSTEM
            out.append(f"{roles[i]}:{texts[i]}")
        elif x in "KR":
            state = NEXT[state]
            out.append(f"{roles[i] if x == 'K' else NAME[state]}:{texts[i]}")
        i += 1
    return out


def illegal(roles: list[str]) -> int:
    return sum((a[:1], b[:1]) not in LEGAL for a, b in zip(roles, roles[1:]))


BLOCK = "conv string, part long, seq long, alone boolean, turns array<long>, roles array<string>, texts array<string>"
PIECE = ("conv string, part long, seq long, gaps long, blank long, duplicate long, truncated long, illegal long, "
         "cost long, audit string, repaired string")
LONG = pa.int64()


def as_batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


PIECE_ROW = pa.schema([("conv", pa.string()), ("part", LONG), ("seq", LONG), ("gaps", LONG), ("blank", LONG), ("duplicate", LONG),
                       ("truncated", LONG), ("illegal", LONG), ("cost", LONG), ("audit", pa.string()), ("repaired", pa.string())])
COUNT = {"blank": "b", "duplicate": "d", "truncated": "t"}


def gaps_of(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else min(high - low + 1 - distinct, (1 << 63) - 1)


def blocks_of(turns: DataFrame, block_rows: int, block_bytes: int) -> DataFrame:
    """Rows of a conversation in order, in blocks; ``alone``: surely its only one."""
    kinds = pa.schema([("conv", pa.string()), ("part", LONG), ("seq", LONG), ("alone", pa.bool_()), ("turns", pa.list_(LONG)),
                       ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, conv, seq, first, size = TaskContext.get().partitionId(), None, 0, True, 0
        held: list[tuple] = []
        out, weight = [], 0

        def block(alone: bool) -> None:
            nonlocal seq, held, size, weight
            turn, role, text = (list(x) for x in zip(*held))
            out.append(dict(conv=conv, part=part, seq=seq, alone=alone, turns=turn, roles=role, texts=text))
            weight += size + 100
            seq, held, size = seq + 1, [], 0

        for b in batches:
            cols = [b.column(c).to_pylist() for c in range(5)]
            for c, turn, role, text, n in zip(*cols):
                if c != conv:
                    if held:
                        block(seq == 0 and not first)
                    first = conv is None
                    conv, seq = c, 0
                while n:
                    if held and (len(held) >= block_rows or size >= block_bytes):
                        block(False)
                    more = min(n, block_rows - len(held), max(1, block_bytes // (len(text) + 50)))
                    held += [(turn, role, text)] * more
                    size += more * (len(text) + 50)
                    n -= more
                if weight >= 4_000_000:
                    yield as_batch(out, kinds)
                    out, weight = [], 0
        if held:
            block(False)
        if out:
            yield as_batch(out, kinds)
        release()

    order = ["conv", "turn", "role", "text"]
    return (turns.repartitionByRange(*order).sortWithinPartitions(*order)
            .select(*order, "n").mapInArrow(pack, BLOCK))


def repair(turns: DataFrame, block_rows: int = 2048, block_bytes: int = 1_000_000) -> DataFrame:
    """Pieces of repaired conversations: conv (the id as text, a space for null), part
    and seq (the pieces' order), audit and repaired (rows ``role:text``, a line each),
    the counts of faults, and on a conversation's last piece its cost and gaps.  Of
    ``turns`` the columns conv_id, turn, role, text are read; a column ``copies``
    says how often a row stands there (else once)."""
    spark = turns.sparkSession
    ship(spark)
    folder = job_dir(spark, "turn-repair")
    copies = F.col("copies").cast("long") if "copies" in turns.columns else F.lit(1).cast("long")
    rows = (turns.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"),
                         F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                         F.coalesce("text", F.lit(" ")).alias("text"), copies.alias("n"))
            .groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n")))
    blocks = written(blocks_of(rows, block_rows, block_bytes), folder, "blocks")

    def one_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                fault = faults(r["roles"], r["texts"], set())
                cost, node, _, tail = finish(programme(r["roles"], fault, NONE))
                known = {t for t in r["turns"] if t is not None}
                audit = letters_of(node) + "I" * tail
                out.append(dict(conv=r["conv"], part=r["part"], seq=r["seq"], cost=cost, audit=audit,
                                repaired="\n".join(rewritten(r["roles"], r["texts"], audit, NONE)) if audit.strip("D") else None,
                                illegal=illegal(r["roles"]), **{k: fault.count(f) for k, f in COUNT.items()},
                                gaps=gaps_of(min(known, default=None), max(known, default=None), len(known))))
            yield as_batch(out, PIECE_ROW)
        release()

    alone = blocks.where("alone").mapInArrow(one_block, PIECE)
    parted = blocks.where("not alone")

    def said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                keys = sorted({digest(x, t) for x, t in zip(r["roles"], r["texts"])})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["conv"]] * len(keys)), pa.array([r["part"]] * len(keys), LONG),
                     pa.array([r["seq"]] * len(keys), LONG), pa.array(keys, pa.binary())], names=["conv", "part", "seq", "key"])

    keys = written(parted.mapInArrow(said, "conv string, part long, seq long, key binary"), folder, "keys")
    earliest = (keys.groupBy("conv", "key").agg(F.min(F.struct("part", "seq")).alias("first"), F.count("*").alias("n"))
                .where("n > 1"))
    earlier = (keys.join(earliest, ["conv", "key"]).where(F.struct("part", "seq") != F.col("first"))
               .groupBy("conv", "part", "seq").agg(F.collect_list("key").alias("earlier")))
    at = ["conv", "part", "seq"]
    parted = written(parted.join(earlier, at, "left"), folder, "parted")

    def fault_of(r: dict) -> list[str]:
        return faults(r["roles"], r["texts"], set(r["earlier"] or ()))

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block: cost and rank of each exit from each entry, and its ends."""
        for b in batches:
            for r in b.to_pylist():
                fault = fault_of(r)
                cost, rank = [], []
                for q in range(4):
                    best = programme(r["roles"], fault, q)
                    ordered: list[int] = []
                    for s, (_, node) in best.items():
                        i = 0
                        while i < len(ordered) and less(best[ordered[i]][1], node):
                            i += 1
                        ordered.insert(i, s)
                    cost += [best[s][0] if s in best else -1 for s in range(4)]
                    rank += [ordered.index(s) if s in best else -1 for s in range(4)]
                known = sorted({t for t in r["turns"] if t is not None})
                yield as_batch([dict(conv=r["conv"], part=r["part"], seq=r["seq"], cost=cost, rank=rank,
                                     first=r["roles"][0][:1], last=r["roles"][-1][:1], low=known[0] if known else None,
                                     high=known[-1] if known else None, turns=len(known))], SUMMARY_ROW)
        release()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of a conversation come together and in order."""
        conv, summaries = None, []

        def chosen():
            best: dict[int, tuple[int, Node | None]] = {NONE: (0, None)}
            for m in summaries:
                step: dict[int, tuple[int, Node | None, int]] = {}
                for q, (cost, node) in best.items():
                    for s in range(4):
                        c = m["cost"][4 * q + s]
                        old = step.get(s)
                        # states of one block are reached by strings that differ before they end
                        if c >= 0 and (old is None or cost + c < old[0] or cost + c == old[0] and less(node, old[1])):
                            step[s] = cost + c, node, m["rank"][4 * q + s]
                best = {s: (cost, Node(node, rank, s)) for s, (cost, node, rank) in step.items()}
            cost, node, _, tail = finish(best)
            states = [NONE] + [n.state for n in node.chain()]
            known = [m for m in summaries if m["low"] is not None]
            distinct = sum(m["turns"] for m in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
            gaps = gaps_of(known[0]["low"], known[-1]["high"], distinct) if known else 0
            n = len(summaries)
            return as_batch([dict(
                conv=conv, part=m["part"], seq=m["seq"], entry=states[i], exit=states[i + 1], tail=tail if i == n - 1 else 0,
                cost=cost if i == n - 1 else 0, gaps=gaps if i == n - 1 else 0,
                between=int(i > 0 and (summaries[i - 1]["last"], m["first"]) not in LEGAL)) for i, m in enumerate(summaries)],
                CHOICE_ROW)

        for b in batches:
            for m in b.to_pylist():
                if m["conv"] != conv:
                    if summaries:
                        yield chosen()
                    conv, summaries = m["conv"], []
                summaries.append(m)
        if summaries:
            yield chosen()

    def write_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                fault = fault_of(r)
                node = programme(r["roles"], fault, r["entry"])[r["exit"]][1]
                audit = letters_of(node) + "I" * r["tail"]
                lines = rewritten(r["roles"], r["texts"], audit, r["entry"])
                yield as_batch([dict(conv=r["conv"], part=r["part"], seq=r["seq"], cost=r["cost"], gaps=r["gaps"], audit=audit,
                                     repaired="\n".join(lines) if lines else None,
                                     illegal=illegal(r["roles"]) + r["between"],
                                     **{k: fault.count(f) for k, f in COUNT.items()})], PIECE_ROW)
        release()

    summaries = parted.mapInArrow(transfer, SUMMARY)
    choices = (summaries.repartition("conv").sortWithinPartitions(*at).mapInArrow(choose, CHOICE))
    return alone.unionByName(parted.join(choices, at).mapInArrow(write_piece, PIECE))


SUMMARY = "conv string, part long, seq long, cost array<long>, rank array<long>, first string, last string, low long, high long, turns long"
SUMMARY_ROW = pa.schema([("conv", pa.string()), ("part", LONG), ("seq", LONG), ("cost", pa.list_(LONG)), ("rank", pa.list_(LONG)),
                         ("first", pa.string()), ("last", pa.string()), ("low", LONG), ("high", LONG), ("turns", LONG)])
CHOICE = "conv string, part long, seq long, entry long, exit long, tail long, cost long, gaps long, between long"
CHOICE_ROW = pa.schema([(n, pa.string() if n == "conv" else LONG) for n in
                        ("conv", "part", "seq", "entry", "exit", "tail", "cost", "gaps", "between")])


def damaged(conversations: DataFrame) -> DataFrame:
    """The query's own damage, by crc32 of ``conv_id:turn``: rows dropped, emptied,
    without end marks, repeated (``copies``) or turned into the user's."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    h = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    return (conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), h.alias("h"))
            .where("h <> 0")
            .select("conv_id", "turn", F.when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("h") == 1, F.lit("")).when(F.col("h") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.when(F.col("h") == 3, 2).otherwise(1).alias("copies")))


def digests(pieces: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: what its pieces say, with the
    whole audit and the checksum of the repaired rows, read piece by piece."""
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv", pa.string()), *((c, LONG) for c in counts), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None

        def row():
            return dict(conv=conv, **state[0], audit="".join(state[1]), repaired_sha256=state[2].hexdigest())

        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["conv"] != conv:
                    if state:
                        out.append(row())
                    conv, state = r["conv"], [dict.fromkeys(counts, 0), [], hashlib.sha256(), False]
                for c in counts:
                    state[0][c] += r[c]
                state[1].append(r["audit"])
                if r["repaired"] is not None:
                    state[2].update((("\n" if state[3] else "") + r["repaired"]).encode())
                    state[3] = True
            yield as_batch(out, schema)
        if state:
            yield as_batch([row()], schema)

    found = (pieces.repartition("conv").sortWithinPartitions("conv", "part", "seq")
             .mapInArrow(whole, f"conv string, {', '.join(c + ' long' for c in counts)}, audit string, repaired_sha256 string"))
    every = conversations.select(F.col("conv_id").alias("conv_id"),
                                 F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    return every.join(found, "conv", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
