"""Conversations put in order by their cheapest edits.

A conversation is well formed if the first letters of its roles read ``(s?(ua)+)?``. Its rows ascend by turn, null first, equal turns
by role and text. Each row's first fault counts: blank (no character but white space), duplicate (its role and text were there
before), truncated (its last character but white space is none of ``.!?``). Keep costs 0, Rerole to user or assistant 2, Delete
3 (blank and duplicate rows must go), Insert an empty user or assistant 2; a truncated row that stays adds 1. The cheapest
edits are taken, of equal ones those whose initials are ASCII-least.

The edits are paths over a lattice: rows used up, and the state of the roles so far. Two heaps, one from the start and one
from the end, settle nodes by turns until no cheaper path can cross; every crossing edge of the least cost is looked at and
the least audit taken. At equal cost two audits of the same rows are never one the prefix of the other (one more Insert
costs more), so the least audit of either half is part of the least whole.

Rows are put in one global order and cut into slabs of 1,024, each a group, so a conversation of any length is shared
by as many tasks as it has slabs. The first and the last conversation of a slab may reach over its edge: for them the search
gives the cheapest path between every two states. Pieces of a conversation are then combined from its end. That
group has 16 paths a slab, whose audits together are a few times the audit that the result returns in one value. Repaired
texts stream by once, in order, through their hash.

Null role or text: one space, so a null text is blank. A null turn comes first, a null conv_id is a conversation. An empty role
has no first letter: the row can be reroled or deleted, not kept. A conversation without rows has cost 0, an empty
audit and the hash of nothing. Repeated rows are duplicates. An empty table has no rows. Long texts are read whole; other
columns, whatever their names, are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcstrata.llm.batches import bound_batches
from cdcstrata.llm.ranges import BLANKS, ranged
from cdcstrata.sources.scratch import materialise

SLAB_BITS = 10
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States by what came last: nothing, a system row, a user, an assistant. The first and the last may end a conversation.
STATES, START, ENDS = range(4), 0, (0, 3)
USER, ASSISTANT = 2, 3
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: What an inserted or reroled row is after each state, and which states lead there.
NEXT = (USER, USER, ASSISTANT, USER)
BEFORE = {USER: (0, 1, 3), ASSISTANT: (2,)}
#: Where a kept row leads to by its first letter, and from where.
KEPT = {("s", 0): 1, ("u", 0): USER, ("u", 1): USER, ("u", 3): USER, ("a", 2): ASSISTANT}
ALLOWED = ("su", "ua", "au")

Row = tuple[str, str]  # first letter and fault: "", "B" (blank), "D" (duplicate) or "T" (truncated)


def _forward(rows: Sequence[Row], i: int, q: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges out of a node: rows used up, state, cost, initial."""
    yield i, NEXT[q], INSERT, "I"
    if i < len(rows):
        letter, fault = rows[i]
        yield i + 1, q, DELETE, "D"
        if fault in ("", "T"):
            more = TRUNCATED if fault else 0
            yield i + 1, NEXT[q], REROLE + more, "R"
            if (letter, q) in KEPT:
                yield i + 1, KEPT[letter, q], KEEP + more, "K"


def _backward(rows: Sequence[Row], i: int, q: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges into a node, named after where they come from."""
    for p in BEFORE.get(q, ()):
        yield i, p, INSERT, "I"
    if i:
        letter, fault = rows[i - 1]
        yield i - 1, q, DELETE, "D"
        if fault in ("", "T"):
            more = TRUNCATED if fault else 0
            for p in BEFORE.get(q, ()):
                yield i - 1, p, REROLE + more, "R"
            for p in STATES:
                if KEPT.get((letter, p)) == q:
                    yield i - 1, p, KEEP + more, "K"


def cheapest(rows: Sequence[Row], start: int = START, ends: Iterable[int] = ENDS) -> tuple[int, str] | None:
    """Least cost and least audit from ``start`` before the rows to one of ``ends`` after them; None where no path leads.

    Heap entries are cost, rows passed, audit so far: edges without cost pass a row, so at one cost a node is settled
    after all that lead to it, and its audit is final.
    """
    n = len(rows)
    heaps = ([(0, 0, "", start)], [(0, 0, "", q) for q in ends])
    done: tuple[dict, dict] = ({}, {})
    best: tuple[int, str] | None = None
    while heaps[0] and heaps[1]:
        if best and heaps[0][0][0] + heaps[1][0][0] > best[0]:
            break
        side = heaps[0][0][0] > heaps[1][0][0]
        cost, passed, audit, q = heappop(heaps[side])
        i = n - passed if side else passed
        if (i, q) in done[side]:
            continue
        done[side][i, q] = cost, audit
        other = done[not side]
        if (i, q) in other:  # the halves meet in a node
            far, rest = other[i, q]
            found = cost + far, rest + audit if side else audit + rest
            best = min(best, found) if best else found
        for j, p, more, initial in (_backward if side else _forward)(rows, i, q):
            if (j, p) in other:  # or in an edge
                far, rest = other[j, p]
                found = cost + more + far, rest + initial + audit if side else audit + initial + rest
                best = min(best, found) if best else found
            if (j, p) not in done[side]:
                heappush(heaps[side], (cost + more, n - j if side else j, initial + audit if side else audit + initial, p))
    return best


def _leads(letter: str, q: int, initial: str) -> int:
    if initial == "D":
        return q
    return KEPT[letter, q] if initial == "K" else NEXT[q]


class Repair:
    """The repaired rows of one conversation, hashed as they come; ``audit`` belongs to the rows from here on."""

    def __init__(self) -> None:
        self.hash, self.state, self.audit, self.at, self.lines = hashlib.sha256(), START, "", 0, 0

    def _line(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state = NEXT[self.state]
            self._line(NAMES[self.state], "")
            self.at += 1

    def piece(self, audit: str) -> None:
        self._inserts()
        self.audit, self.at = audit, 0

    def row(self, role: str, text: str) -> None:
        self._inserts()
        initial = self.audit[self.at]
        self.at += 1
        self.state = _leads(role[:1], self.state, initial)
        if initial != "D":
            self._line(role if initial == "K" else NAMES[self.state], text)

    def end(self) -> str:
        self._inserts()
        return self.hash.hexdigest()


def ordered(conversations: DataFrame) -> DataFrame:
    """Rows in their order, stored, with ``place``; nulls of role and text are a space."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    return ranged(rows, ["conv_id", "turn", "role", "text"], "turns").drop("part")


def _faulty(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``place``, ``letter`` and ``fault`` of each row; the texts stay where they are."""
    bare = F.btrim("text", F.lit(BLANKS))
    own = F.when(F.length(bare) == 0, "B").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "T").otherwise("")
    slim = rows.select(
        "conv_id", "turn", "place", F.substring("role", 1, 1).alias("letter"), own.alias("own"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("same"),
    )
    # The first of equal rows by partial aggregation, found again by its place: no key of either step is a hot one.
    first = slim.groupBy("conv_id", "same").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = F.when(F.col("first").isNull() & (F.col("own") != "B"), "D").otherwise(F.col("own"))
    return slim.join(first, "place", "left").select("conv_id", "turn", "place", "letter", fault.alias("fault"))


_PIECES = "conv_id bigint, slab bigint, place bigint, first string, last string, illegal bigint, paths array<struct<start:int,end:int,cost:bigint,audit:string>>"


_PATHS_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_PIECES_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("slab", pa.int64()), ("place", pa.int64()), ("first", pa.string()), ("last", pa.string())]
    + [("illegal", pa.int64()), ("paths", _PATHS_ARROW)]
)


def _searched(slab: pa.Table) -> pa.Table:
    """The cheapest paths through each conversation's piece of a slab."""
    rows = sorted(slab.to_pylist(), key=lambda r: r["place"])
    pieces: list[list[dict]] = []
    for r in rows:
        if not pieces or pieces[-1][0]["conv_id"] != r["conv_id"]:
            pieces.append([])
        pieces[-1].append(r)
    out = []
    for k, piece in enumerate(pieces):
        letters = [r["letter"] for r in piece]
        steps = [(r["letter"], r["fault"]) for r in piece]
        if 0 < k < len(pieces) - 1:
            ways = [(START, ENDS[0], ENDS)]
        else:
            ways = [(p, q, (q,)) for p in STATES for q in STATES]
        paths = [(p, q, cheapest(steps, p, ends)) for p, q, ends in ways]
        out.append(
            {
                "conv_id": piece[0]["conv_id"],
                "slab": piece[0]["slab"],
                "place": piece[0]["place"],
                "first": letters[0],
                "last": letters[-1],
                "illegal": sum(a + b not in ALLOWED for a, b in zip(letters, letters[1:], strict=False)),
                "paths": [{"start": p, "end": q, "cost": f[0], "audit": f[1]} for p, q, f in paths if f],
            }
        )
    return pa.Table.from_pylist(out, _PIECES_ARROW)


_CHOSEN = "conv_id bigint, place bigint, piece string, cost bigint, illegal bigint"
_CHOSEN_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("piece", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64())]
)


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of whole conversations in order, each conversation put together; the pieces of one are held."""
    pieces: list[dict] = []
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if pieces and r["conv_id"] != pieces[0]["conv_id"]:
                out += _chosen(pieces)
                pieces = []
            pieces.append(r)
        yield pa.RecordBatch.from_pylist(out, _CHOSEN_ARROW)
    if pieces:
        yield pa.RecordBatch.from_pylist(_chosen(pieces), _CHOSEN_ARROW)


def _chosen(rows: Sequence[dict]) -> list[dict]:
    """The cheapest way through the pieces of one conversation, from the end: the audit of each; totals with the first."""
    rest: dict[int, tuple[int, str, tuple | None]] = {q: (0, "", None) for q in ENDS}
    for r in reversed(rows):
        found: dict[int, tuple[int, str, tuple | None]] = {}
        for p in r["paths"]:
            if p["end"] in rest:
                cost, audit, after = rest[p["end"]]
                # Audits of later pieces are compared as wholes, and only at equal cost.
                way = p["cost"] + cost, p["audit"] + audit, (p["audit"], after)
                if p["start"] not in found or way[:2] < found[p["start"]][:2]:
                    found[p["start"]] = way
        rest = found
    cost, _, chain = rest[START]
    illegal = sum(r["illegal"] for r in rows)
    illegal += sum(a["last"] + b["first"] not in ALLOWED for a, b in zip(rows, rows[1:], strict=False))
    out = []
    for k, r in enumerate(rows):
        piece, chain = chain
        out.append({"conv_id": r["conv_id"], "place": r["place"], "piece": piece, "cost": 0 if k else cost, "illegal": 0 if k else illegal})
    return out


_REPAIRED = "conv_id bigint, audit string, repaired_sha256 string"
_REPAIRED_ARROW = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole conversations in order; one batch and the open conversation's audit are held, no text beyond."""
    open_id, repair, audit = None, None, []

    def result() -> dict:
        return {"conv_id": open_id, "audit": "".join(audit), "repaired_sha256": repair.end()}

    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if repair is None or r["conv_id"] != open_id:
                if repair is not None:
                    out.append(result())
                open_id, repair, audit = r["conv_id"], Repair(), []
            if r["piece"] is not None:
                repair.piece(r["piece"])
                audit.append(r["piece"])
            repair.row(r["role"], r["text"])
        yield pa.RecordBatch.from_pylist(out, _REPAIRED_ARROW)
    if repair is not None:
        yield pa.RecordBatch.from_pylist([result()], _REPAIRED_ARROW)


def repaired(conversations: DataFrame) -> DataFrame:
    """One row per conversation that has rows: its faults, the cost and audit of its repair, the hash of what that gives."""
    bound_batches(conversations.sparkSession)
    rows = ordered(conversations.withColumn("conv_id", F.col("conv_id").cast("bigint")))
    faults = materialise(_faulty(rows), "turn-faults")
    of = lambda kind: F.count(F.when(F.col("fault") == kind, 1))
    gaps = F.max("turn").cast("bigint") - F.min("turn").cast("bigint") + 1 - F.count_distinct("turn")
    counts = faults.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"),
        of("B").alias("blank"),
        of("D").alias("duplicate"),
        of("T").alias("truncated"),
    )
    slabs = faults.select("conv_id", "place", "letter", "fault", F.shiftright("place", SLAB_BITS).alias("slab"))
    pieces = slabs.groupBy("slab").applyInArrow(_searched, _PIECES)
    # Dealt by number, as rows that cost this much to handle are too few bytes for adaptive sizes to keep apart.
    tasks = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "slab")
    chosen = materialise(dealt.mapInArrow(_combined, _CHOSEN), "turn-edits")
    totals = chosen.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    edited = rows.join(chosen.select("place", "piece"), "place", "left").select("conv_id", "place", "role", "text", "piece")
    texts = edited.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_streamed, _REPAIRED)
    return _beside(_beside(counts, totals), texts).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def _beside(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joined by conv_id, null equal to null."""
    right = right.withColumnRenamed("conv_id", "__conv_id")
    return left.join(right, F.col("conv_id").eqNullSafe(F.col("__conv_id")), how).drop("__conv_id")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as the damage of the registered query leaves them, by a hash of conversation and turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    key = F.concat(conv_id, F.lit(":"), turn)
    kind = F.col("__kind")
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("__kind"),
    )
    return rows.filter(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
    ).drop("__copy")


def repair_damage(conversations: DataFrame) -> DataFrame:
    """Every original conversation, damaged and repaired; one that lost all its rows has zeros and an empty audit."""
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    rows = _beside(ids, repaired(damaged(conversations)), "left")
    zero: list[Column] = [
        F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ]
    return rows.select(
        "conv_id",
        *zero,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
