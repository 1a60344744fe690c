"""Repair of conversations: a generalised LR parse of their roles with weighted edits.

The role grammar is ``C -> nothing | T | s T`` and ``T -> u a | T u a`` (s, u, a: system,
user, assistant). An LR table shifts roles and reduces turns. Every row may be kept
(if its role can be shifted), get the role that can be shifted, or be deleted, and
roles may be inserted before rows and at the end; each action has a cost and a letter.
The stacks of all choices form a graph: after each row, stacks with the same top are
merged, and the one of least (cost, audit) stays, the audit being the letters so far.
A merge loses nothing: in this grammar equal tops have the same continuations.

Only the order of the live audits matters for the merges. No live audit begins with
another one (they have the same rows, and end with a row's letter), so an order once
found is kept, and the letters are read back from the links of the rows in the end.
What a row does to the live stacks depends only on their tops, on cost differences, of
which those over MARGIN cannot win any more, and on the kind of the row; so these
steps are tabled.

A conversation may be larger than a task should hold. Rows are dealt out by ranges of
(conversation, turn, ..), so the rows of a large one lie in several tasks. The first
and the last conversation of each task are parsed from every stack that can be there at
its first row; such results are combined in order, one row for each task.

Defined cases of the table: a null id is a conversation of its own; null turns come
first; a null role or text is one space, so a null text is blank and a null role
is no role; rows of equal turn go by role, then by text; equal rows repeat each other;
further columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import written

# ---- the LR machine -------------------------------------------------------------------------

#: (state, role) to the state that shifting it leads to.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (4, "u"): 6, (5, "u"): 6, (6, "a"): 7}
#: State to how many states a reduction takes off the stack: ``T -> u a`` and ``T -> T u a``.
REDUCE = {3: 2, 7: 3}
#: State below a reduced T to the state of T.
GOTO = {0: 4, 1: 5}
ACCEPT = {0, 4, 5}
ROLE = {"u": "user", "a": "assistant"}

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
#: What a truncated row that stays adds.
TRUNCATED = 1
#: The least cost of any stack plus this is what another may cost: with two inserts (4) and one row more deleted than kept (3), the cheapest stack can do all that another can.
MARGIN = 7

Stack = tuple[int, ...]


@functools.cache
def shifted(stack: Stack, role: str) -> Stack | None:
    """The stack after a role, with all reductions; None if the role has no place."""
    to = SHIFT.get((stack[-1], role))
    if to is None:
        return None
    stack = (*stack, to)
    while stack[-1] in REDUCE:
        stack = stack[: -REDUCE[stack[-1]]]
        stack = (*stack, GOTO[stack[-1]])
    return stack


@functools.cache
def inserted(stack: Stack) -> tuple[tuple[str, Stack], ...]:
    """The stacks that up to two inserts lead to, with the letters of the inserts; more only go in circles."""
    out = [("", stack)]
    while len(out) < 3:
        out.append((out[-1][0] + "I", _next(out[-1][1])[1]))
    return tuple(out)


def _next(stack: Stack) -> tuple[str, Stack]:
    """The role among user and assistant that can be shifted, of which there is always one, and the stack after it."""
    return next((role, to) for role in "ua" if (to := shifted(stack, role)) is not None)


def all_stacks() -> list[Stack]:
    """Every stack that can stand between two rows."""
    found, open_ = [(0,)], [(0,)]
    while open_:
        stack = open_.pop()
        for role in "sua":
            if (to := shifted(stack, role)) is not None and to not in found:
                found.append(to)
                open_.append(to)
    return found


STACKS = all_stacks()
#: Live stacks in the order of their audits: (stack, cost over the least).
Live = tuple[tuple[Stack, int], ...]


@functools.cache
def step(live: Live, role: str, truncated: bool) -> tuple[Live, int, tuple[tuple[int, str], ...]]:
    """What a row that is neither blank nor a repeat does: live stacks, what the least cost grows by, and (number of the stack before, letters) for each."""
    extra = TRUNCATED if truncated else 0
    best: dict[int, tuple[tuple, Stack]] = {}  # by stack top

    def offer(cost: int, order: int, letters: str, stack: Stack) -> None:
        key = (cost, order, letters)
        if stack[-1] not in best or key < best[stack[-1]][0]:
            best[stack[-1]] = (key, stack)

    for order, (stack, cost) in enumerate(live):
        offer(cost + DELETE, order, "D", stack)
        for letters, at in inserted(stack):
            paid = cost + INSERT * len(letters) + extra
            if (to := shifted(at, role)) is not None:
                offer(paid + KEEP, order, letters + "K", to)
            offer(paid + REROLE, order, letters + "R", _next(at)[1])
    least = min(key[0] for key, _ in best.values())
    kept = sorted((b for b in best.values() if b[0][0] <= least + MARGIN), key=lambda b: b[0][1:])
    return tuple((stack, key[0] - least) for key, stack in kept), least, tuple((key[1], key[2]) for key, _ in kept)


class Parse:
    """The graph of stacks of one conversation, or of a stretch of it, from one stack on."""

    def __init__(self, stack: Stack = (0,)) -> None:
        self.live: Live = ((stack, 0),)
        self.cost = 0
        self.links: list[tuple[tuple[int, str], ...] | int] = []

    def row(self, role: str, truncated: bool) -> None:
        self.live, more, links = step(self.live, role, truncated)
        self.cost += more
        self.links.append(links)

    def deletions(self, n: int) -> None:
        """n rows that must go: all stacks stay, with a letter more each."""
        self.cost += DELETE * n
        if self.links and isinstance(self.links[-1], int):
            self.links[-1] += n
        elif n:
            self.links.append(n)

    def audit(self, at: int) -> str:
        """The letters that lead to a live stack."""
        out = []
        for link in reversed(self.links):
            if isinstance(link, int):
                out.append("D" * link)
            else:
                at, letters = link[at]
                out.append(letters)
        return "".join(reversed(out))

    def ends(self) -> dict[Stack, tuple[int, str]]:
        """(cost, audit) of each live stack."""
        return {stack: (self.cost + cost, self.audit(k)) for k, (stack, cost) in enumerate(self.live)}

    def best(self) -> tuple[int, str]:
        return finished(self.ends())


def finished(ends: dict[Stack, tuple[int, str]]) -> tuple[int, str]:
    """The least (cost, audit) that the end of the conversation can follow."""
    return min((cost + INSERT * len(letters), audit + letters) for stack, (cost, audit) in ends.items() for letters, to in inserted(stack) if to[-1] in ACCEPT)


class Writer:
    """SHA-256 of the repaired conversation, row by row along an audit."""

    def __init__(self, audit: str) -> None:
        self.letters, self.stack, self.hash, self.first = iter(audit), (0,), hashlib.sha256(), True

    def put(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def row(self, role: str, text: str) -> None:
        for letter in self.letters:
            if letter == "K":
                self.stack = shifted(self.stack, role[:1])
                self.put(role, text)
            elif letter in "IR":
                initial, self.stack = _next(self.stack)
                self.put(ROLE[initial], text if letter == "R" else "")
            if letter != "I":
                return

    def skip(self, n: int) -> None:
        for _ in range(n):
            self.row("", "")

    def end(self) -> str:
        self.row("", "")  # only inserts are left
        return self.hash.hexdigest()


# ---- one row after the other ----------------------------------------------------------------

SPACE = "\x20\x09-\x0d"
_last = re.compile(f"[^{SPACE}](?=[{SPACE}]*\\Z)")
_seen = re.compile(f"[^{SPACE}]")


def fault(text: str, repeated: bool) -> str | None:
    """The first fault of a row."""
    if not _seen.search(text):
        return "blank"
    if repeated:
        return "duplicate"
    return None if _last.search(text).group() in ".!?" else "truncated"


class Stretch:
    """Rows of one conversation in order, within one task: counts, parses, and the texts as long as they may be needed for the digest."""

    def __init__(self, conv: int | None, any_start: bool) -> None:
        self.conv = conv
        self.parses = {stack: Parse(stack) for stack in (STACKS if any_start else STACKS[:1])}
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns: list[int] = []  # least, greatest, number of distinct ones
        self.first_role: str | None = None
        self.last_role: str | None = None
        self.kept: list[tuple[str, str] | int] | None = []
        self.held = 0

    def row(self, turn: int | None, role: str, text: str, n: int, repeated: bool, most: int) -> None:
        """n equal rows, the first of which repeats one before it or not."""
        if not n:
            return
        if turn is not None:
            low, high, distinct = self.turns or (turn, None, 0)
            self.turns = [low, turn, distinct + (turn != high)]
        initial = role[:1]
        if self.last_role is not None:
            self.counts["illegal"] += self.last_role + initial not in ("su", "ua", "au")
        else:
            self.first_role = initial
        self.last_role = initial
        self.counts["illegal"] += (n - 1) * (initial + initial not in ("su", "ua", "au"))
        found = fault(text, repeated)
        if found:
            self.counts[found] += 1
        again = n - 1
        if again:
            self.counts["blank" if found == "blank" else "duplicate"] += again
        gone = found in ("blank", "duplicate")
        for parse in self.parses.values():
            if not gone:
                parse.row(initial, found == "truncated")
            if again + gone:
                parse.deletions(again + gone)
        if self.kept is not None:
            if not gone:
                self.kept.append((role, text))
                self.held += len(text) + ROW_SIZE
            if again + gone:
                self.kept.append(again + gone)
            if self.held > most:
                self.kept = None

    def digest(self, audit: str) -> str | None:
        if self.kept is None:
            return None
        writer = Writer(audit)
        for x in self.kept:
            writer.skip(x) if isinstance(x, int) else writer.row(*x)
        return writer.end()


# ---- the table ------------------------------------------------------------------------------

#: Characters of one conversation that a task keeps for its digest; the digests of longer ones are taken from the sorted rows as they pass.
HELD = 1 << 24
#: What a row counts for besides its text.
ROW_SIZE = 100
#: Characters of a text by which ranges may be cut.
RANGE_TEXT = 64

_COUNTS = ("blank", "duplicate", "truncated", "illegal")
STRETCH = "conv_id long, part int, open boolean, low long, high long, distinct long, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, cost long, audit string, repaired_sha256 string, paths array<struct<begin:int,end:int,cost:long,audit:string>>"
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): rows after damage by the hash of id and turn, n of each; a dropped row leaves one of n = 0."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20
    gone = kind == 0
    role = F.when(gone, "").when(kind == 4, "user").otherwise(or_space("role"))
    text = F.when(gone | (kind == 1), "").when(kind == 2, F.regexp_replace(or_space("text"), "[.!?]", "")).otherwise(or_space("text"))
    return rows.select(F.col("conv_id").cast("long"), F.when(~gone, F.col("turn")).cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.when(gone, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("n"))


def marked(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, n), equal ones as one with their number, and ``repeated``: whether an earlier turn has the same role and text."""
    rows = written(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")), "turns")
    digest = F.sha2("text", 256)
    met = rows.filter("n > 0").groupBy("conv_id", "role", digest.alias("digest")).agg(F.count(F.lit(1)).alias("turns"), F.min(F.struct(F.col("turn").isNotNull().alias("later"), "turn")).alias("first"))
    # written, so that the rows of a key with very many can be dealt out in the join; few texts come twice
    met = written(met.filter("turns > 1").select("conv_id", "role", "digest", F.col("first.turn").alias("first")), "repeated-turns")
    left, right = rows.withColumn("digest", digest).alias("l"), met.alias("r")
    same = F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("l.role") == F.col("r.role")) & (F.col("l.digest") == F.col("r.digest"))
    joined = left.join(right, same, "left")
    return joined.select("l.conv_id", "l.turn", "l.role", "l.text", "l.n", (F.col("r.digest").isNotNull() & ~F.col("l.turn").eqNullSafe(F.col("r.first"))).alias("repeated"))


def _in_order(rows: DataFrame, *before: str) -> DataFrame:
    return rows.sortWithinPartitions("conv_id", *before, F.col("turn").asc_nulls_first(), "role", "text")


def _stretches(rows: DataFrame, parts: int | None, held: int) -> DataFrame:
    """A row (STRETCH) for each conversation and task; ``open`` if other tasks may have rows of it."""
    key = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, RANGE_TEXT)]
    dealt = rows.repartitionByRange(parts, *key) if parts else rows.repartitionByRange(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, out, first = TaskContext.get().partitionId(), None, [], True

        def close(open_: bool) -> None:
            whole = now.parses[(0,)].best()
            paths = None
            if open_:
                paths = [{"begin": STACKS.index(b), "end": STACKS.index(e), "cost": c, "audit": a} for b, p in now.parses.items() for e, (c, a) in p.ends().items()]
            low, high, distinct = now.turns or (None, None, 0)
            out.append((now.conv, part, open_, low, high, distinct, *(now.counts[c] for c in _COUNTS), now.first_role, now.last_role, *whole, now.digest(whole[1]), paths))

        for batch in batches:
            for conv, turn, role, text, n, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        close(first)
                        first = False
                    # only the first conversation of a task can have begun in another one
                    now = Stretch(conv, now is None)
                now.row(turn, role, text, n, repeated, held)
            if out:
                yield _batch(out, STRETCH)
                out = []
        if now is not None:
            close(True)
            yield _batch(out, STRETCH)

    return _in_order(dealt).mapInArrow(run, STRETCH)


_ARROW = {
    "conv_id": pa.int64(), "part": pa.int32(), "open": pa.bool_(), "first_role": pa.string(), "last_role": pa.string(), "audit": pa.string(), "repaired_sha256": pa.string(),
    "paths": pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])),
}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = re.findall(r"(?:^|, )(\w+) ", schema)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW.get(n, pa.int64())) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names)


def _combined(table: pa.Table) -> pa.Table:
    """One result of the stretches of one conversation, in the order of their tasks; the digest is left null if they are several."""
    rows = sorted((r for r in table.to_pylist()), key=lambda r: r["part"])
    conv = rows[0]["conv_id"]
    full = [r for r in rows if r["first_role"] is not None]
    if len(full) <= 1:  # tasks beside it had only dropped rows, if any
        r = (full or rows)[0]
        if r["repaired_sha256"] is not None:
            return pa.Table.from_batches([_batch([_result(r, r["low"], r["high"], r["distinct"], {c: r[c] for c in _COUNTS}, r["cost"], r["audit"], r["repaired_sha256"])], RESULT)])
    counts, low, high, distinct, role = dict.fromkeys(_COUNTS, 0), None, None, 0, None
    ends: dict[Stack, tuple[int, str]] = {(0,): (0, "")}
    for r in full:
        for c in _COUNTS:
            counts[c] += r[c]
        if role is not None:
            counts["illegal"] += role + r["first_role"] not in ("su", "ua", "au")
        role = r["last_role"]
        if r["low"] is not None:
            distinct += r["distinct"] - (high == r["low"])
            low, high = r["low"] if low is None else low, r["high"]
        tops: dict[int, tuple[int, str, Stack]] = {}
        for p in r["paths"]:
            if (begun := ends.get(STACKS[p["begin"]])) is not None:
                to = STACKS[p["end"]]
                offer = (begun[0] + p["cost"], begun[1] + p["audit"], to)
                if to[-1] not in tops or offer[:2] < tops[to[-1]][:2]:
                    tops[to[-1]] = offer
        ends = {stack: (cost, audit) for cost, audit, stack in tops.values()}
    return pa.Table.from_batches([_batch([_result({"conv_id": conv}, low, high, distinct, counts, *finished(ends), None)], RESULT)])


def _result(r: dict, low: int | None, high: int | None, distinct: int, counts: dict[str, int], cost: int, audit: str, sha: str | None) -> tuple:
    gaps = 0 if low is None else high - low + 1 - distinct
    return (r["conv_id"], gaps, *(counts[c] for c in _COUNTS), cost, audit, sha)


def _digests(rows: DataFrame, results: DataFrame) -> DataFrame:
    """(conv_id, sha): digests of conversations that no task had whole, from their rows as they pass in order, the audit before them."""
    heads = results.select("conv_id", F.lit(0).alias("place"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("repeated"))
    same = F.col("m.conv_id").eqNullSafe(F.col("w.conv_id"))
    theirs = rows.alias("m").join(results.select("conv_id").alias("w"), same, "left_semi").filter("n > 0")
    both = heads.unionByName(theirs.select("conv_id", F.lit(1).alias("place"), "turn", "role", "text", "n", "repeated"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, writer = None, None
        for batch in batches:
            for conv_id, place, role, text, n, repeated in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "place", "role", "text", "n", "repeated")), strict=True):
                if place == 0:
                    if writer is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([writer.end()])], ["conv_id", "sha"])
                    conv, writer = conv_id, Writer(text)
                else:
                    gone = fault(text, repeated) in ("blank", "duplicate")
                    if not gone:
                        writer.row(role, text)
                    writer.skip(n - (not gone))
        if writer is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([writer.end()])], ["conv_id", "sha"])

    return _in_order(both.repartition("conv_id"), "place").mapInArrow(run, "conv_id long, sha string")


def repair(rows: DataFrame, parts: int | None = None, held: int = HELD) -> DataFrame:
    """A row (RESULT) for each conversation of rows (conv_id, turn, role, text, n).

    ``parts``: number of ranges, by default that of shuffles. A conversation whose texts
    are longer than ``held``, or lie in several tasks, is digested in a second pass, in
    which one task streams its rows: the digest of one sequence asks for that.
    """
    rows = written(marked(rows), "marked-turns")
    found = written(_stretches(rows, parts, held), "stretches")
    gaps = F.when(F.col("low").isNull(), 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("distinct"))
    closed = found.filter("not open").select("conv_id", gaps.cast("long").alias("gaps"), *_COUNTS, "cost", "audit", "repaired_sha256")
    results = closed.unionByName(written(found.filter("open").groupBy("conv_id").applyInArrow(_combined, RESULT), "combined"))
    long = written(results.filter("repaired_sha256 is null"), "long-conversations")
    shas = _digests(rows, long)
    same = F.col("l.conv_id").eqNullSafe(F.col("d.conv_id"))
    late = long.alias("l").join(shas.alias("d"), same).select(*[f"l.{c}" for c in results.columns[:-1]], F.col("d.sha").alias("repaired_sha256"))
    return results.filter("repaired_sha256 is not null").unionByName(late)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
