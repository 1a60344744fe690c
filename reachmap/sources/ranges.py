"""Large files whose records go over line ends, read in byte ranges by many tasks.

Spark's text source deals a file out in ranges; here its rows are *parts*: lines of
delimited text, or what lies between closing brackets of a JSON array. Whether a part
begins inside a quoted text, and how deep in brackets, is not known to a task that has
only its range. So there are two passes.

* Each range is scanned from both states, outside and inside of quotes. The outcome
  is a row for each range: the state at its end, the change of depth, and the least depth at
  which a record could end. These rows compose: going through those of a file in order
  gives the state at the start of every range, and the range in which a record that is
  open there began.
* Each range is cut into records, from the state it begins with. A record that lies in
  one range is a row; pieces of one that goes over a border carry the number of the
  range it began in, and are put together by that.

Only ranges that begin inside a record are told to all tasks, with three numbers each
(about 30 bytes): for 100 TB in ranges of 128 MB that is 25 MB if all do. The second
pass must see the ranges of the first; it raises an error if Spark dealt them out
otherwise, as it may if the number of cores has changed in between.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import written


@dataclass(frozen=True)
class Delimited:
    """Records of delimited text: a record ends at a line end outside of quotes; a doubled quote stands for one."""

    sep: bytes = b","
    encoding: str = "UTF-8"
    end: str = "\n"
    base: int = 0

    def needed(self, value: Column, block: Column) -> Column:
        """What the first pass needs of a part: of lines without quotes only that they are there."""
        return F.when(value.contains('"') | (block == 0), value)

    def walk(self, line: bytes, quoted: bool) -> tuple[bool, int]:
        """Whether the line ends inside of quotes, and its separators outside. A quote counts at the start of a field only."""
        at, n = 0, 0
        while True:
            if quoted or line[at : at + 1] == b'"':
                at += not quoted
                while (at := line.find(b'"', at)) >= 0 and line[at + 1 : at + 2] == b'"':
                    at += 2
                if at < 0:
                    return True, n
                quoted = False
            at = line.find(self.sep, at)
            if at < 0:
                return False, n
            at, n = at + 1, n + 1

    def state(self, part: bytes | None, quoted: bool, depth: int) -> tuple[bool, int, list[int]]:
        if part is None or b'"' not in part:
            return quoted, 0, []
        return self.walk(part, quoted)[0], 0, []

    def begin(self, part: bytes, depth: int, opens: list[int]) -> int | None:
        """Where a record begins in a part: nowhere in a blank line."""
        return 0 if part.strip() else None

    def whole(self, record: bytes, ended: bool) -> tuple[str, int]:
        """The record, without its line end, and its number of fields."""
        record = record.removesuffix(b"\n") if not ended else record.removesuffix(b"\r")
        n = record.count(self.sep) if b'"' not in record else self.walk(record, False)[1]
        return record.decode(self.encoding, "replace"), n + 1


@dataclass(frozen=True)
class Elements:
    """Elements of a JSON array: arrays (``[``, depth 1) or objects (``{``, depth 0). Parts end at closing brackets of the kind."""

    open: bytes = b"["
    end: str = "]"
    base: int = 1
    token: re.Pattern = field(init=False, compare=False)

    #: From inside a string to its end.
    rest = re.compile(rb'[^"\\]*(?:\\.[^"\\]*)*"', re.S)

    def __post_init__(self) -> None:
        object.__setattr__(self, "token", re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*("?)|' + re.escape(self.open), re.S))

    def needed(self, value: Column, block: Column) -> Column:
        return value

    def state(self, part: bytes, quoted: bool, depth: int) -> tuple[bool, int, list[int]]:
        """State and depth after a part and its closing bracket, which counts outside of strings; and where brackets open."""
        at, opens = 0, []
        if quoted:
            end = self.rest.match(part)
            if end is None:
                return True, depth, []
            at = end.end()
        for m in self.token.finditer(part, at):
            if m[0] == self.open:
                opens.append(m.start())
            elif not m[1]:
                return True, depth + len(opens), opens
        return False, depth + len(opens) - 1, opens

    def begin(self, part: bytes, depth: int, opens: list[int]) -> int | None:
        return opens[self.base - depth] if 0 <= self.base - depth < len(opens) else None

    def whole(self, record: bytes, ended: bool) -> tuple[str, int]:
        return (record + self.end.encode() if ended else record).decode("UTF-8", "replace"), 0


ARRAYS, OBJECTS = Elements(), Elements(b"{", "}", 0)
Format = Delimited | Elements

#: Stands for the place after a file's last range.
END = -1
SUMMARY = "file string, block long, size long, " + ", ".join(f"quoted_{s} boolean, change_{s} long, least_{s} long" for s in (0, 1)) + ", head string"
PIECE = "file string, owner long, block long, ended boolean, record string, n int, raw binary"


def parts(spark: SparkSession, path: str, form: Format) -> DataFrame:
    """(file, block, size, value): the parts of all files, each range in order within one task."""
    value = F.col("value")
    rows = spark.read.option("lineSep", form.end).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_block_length").alias("size"), value)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, list[bytes | None]]]:
    """Stretches of parts of one range."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        code = file.indices.to_numpy()
        cuts = [0, *(np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield file.dictionary[int(code[a])].as_py(), int(block[a]), batch.column(2)[a].as_py(), batch.column(3).slice(a, b - a).to_pylist()


class _Scan:
    """What is known of a range, from each state at its start."""

    def __init__(self, form: Format, block: int) -> None:
        self.form, self.ends = form, [[False, 0, None], [True, 0, None]]
        self.head: Cutter | None = Cutter(form, False, 0, None, 0) if block == 0 else None
        self.first: str | None = None

    def add(self, values: list[bytes | None]) -> None:
        state = self.form.state
        for end in self.ends:
            quoted, depth, least = end
            for part in values:
                quoted, depth, _ = state(part, quoted, depth)
                if not quoted and (least is None or depth < least):
                    least = depth
            end[:] = quoted, depth, least
        if self.head is not None and self.first is None:
            for part in values:
                if (record := self.head.part(part)) is not None:
                    self.first = record[0]
                    break


class Cutter:
    """Cuts the parts of one range into records."""

    def __init__(self, form: Format, quoted: bool, depth: int, owner: int | None, block: int) -> None:
        self.form, self.quoted, self.depth, self.owner, self.block = form, quoted, depth, owner, block
        self.held: list[bytes] = []
        self.open = owner is not None
        self.whole = not self.open  # whether what is held began in this range

    def part(self, part: bytes) -> tuple[str, int] | bytes | None:
        """A whole record that ends with this part; or, as bytes, the last piece of one that began in another range."""
        form, before = self.form, self.depth
        if not self.open and isinstance(form, Delimited) and b'"' not in part:
            return form.whole(part, True) if part.strip() else None
        self.quoted, self.depth, opens = form.state(part, self.quoted, before)
        if not self.open:
            at = form.begin(part, before, opens)
            if at is None:
                return None
            self.open, part = True, part[at:]
        self.held.append(part)
        if self.quoted or self.depth > form.base:
            return None
        record, self.held, self.open = form.end.encode().join(self.held), [], False
        if self.whole:
            return form.whole(record, True)
        self.whole = True
        return record

    def rest(self) -> bytes | None:
        """The piece of a record that goes on in the next range."""
        return b"".join(p + self.form.end.encode() for p in self.held) if self.open else None


def _summaries(spark: SparkSession, path: str, form: Format) -> DataFrame:
    names = re.findall(r"(\w+) \w+(?:, |$)", SUMMARY)
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.bool_(), pa.int64(), pa.int64()] * 2, pa.string()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key = None, None

        def row() -> pa.RecordBatch:
            values = [*key, *now.ends[0], *now.ends[1], now.first]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for file, block, size, values in _runs(batches):
            if key != (file, block, size):
                if now is not None:
                    yield row()
                now, key = _Scan(form, block), (file, block, size)
            now.add(values)
        if now is not None:
            yield row()

    rows = parts(spark, path, form)
    return rows.withColumn("value", form.needed(F.col("value"), F.col("block")).cast("binary")).mapInArrow(scan, SUMMARY)


def _opened(summaries: DataFrame, form: Format) -> DataFrame:
    """(file, block, quoted, depth, owner) of the ranges that begin inside a record; the block END stands for a record that the end of the file leaves open."""
    base = form.base

    def compose(table: pa.Table) -> pa.Table:
        out, quoted, depth, owner = [], False, 0, None
        for r in sorted(table.to_pylist(), key=lambda r: r["block"]):
            if owner is not None:
                out.append((r["file"], r["block"], quoted, depth, owner))
            s = int(quoted)
            goes_on = owner is not None and (r[f"least_{s}"] is None or depth + r[f"least_{s}"] > base)
            quoted, depth = r[f"quoted_{s}"], depth + r[f"change_{s}"]
            owner = (owner if goes_on else r["block"]) if quoted or depth > base else None
        if owner is not None:
            out.append((table["file"][0].as_py(), END, quoted, depth, owner))
        columns = zip(*out, strict=True) if out else [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "quoted", "depth", "owner"])

    return summaries.groupBy("file").applyInArrow(compose, "file string, block long, quoted boolean, depth long, owner long")


def read_records(spark: SparkSession, path: str, form: Format) -> tuple[DataFrame, DataFrame]:
    """(file, record, n) and (file, head): all records of all files but the first of each, as text, ``n`` fields each; and the first ones.

    A record that the end of the file leaves open is a record. The first record of a file must end in its first range.
    """
    summaries = written(_summaries(spark, path, form), "ranges")
    heads = summaries.filter("block = 0 and head is not null").select("file", "head")
    if (long := summaries.filter("block = 0 and head is null").filter(F.col("quoted_0") | (F.col("change_0") > form.base)).first()) is not None:
        raise ValueError(f"the first record of {long['file']} does not end in its first {long['size']} bytes")
    most = summaries.agg(F.max("size")).first()[0] or 1
    by: dict[str, dict[int, tuple[bool, int, int]]] = {}
    for file, block, *state in zip(*(c.to_pylist() for c in _opened(summaries, form).toArrow().columns), strict=True):
        by.setdefault(file, {})[block] = tuple(state)
    shared = spark.sparkContext.broadcast(by)
    base = form.base
    names = re.findall(r"(\w+) \w+(?:, |$)", PIECE)
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int32(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key, out, held, first = None, None, [], 0, False

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        def last() -> None:
            if (rest := now.rest()) is not None:
                out.append((key[0], key[1] if now.whole else now.owner, key[1], False, None, None, rest))

        for file, block, size, values in _runs(batches):
            if key != (file, block):
                if block % most or size > most:
                    raise RuntimeError(f"the range at {block} of {file} is not one of the first pass: read it again")
                if now is not None:
                    last()
                key, first = (file, block), block == 0
                quoted, depth, owner = shared.value.get(file, {}).get(block) or (False, base if block else 0, None)
                now = Cutter(form, quoted, depth, owner, block)
            for part in values:
                record = now.part(part)
                if record is None:
                    continue
                if isinstance(record, bytes):
                    out.append((file, now.owner, block, True, None, None, record))
                    held += len(record)
                elif first:
                    first = False
                else:
                    out.append((file, None, block, True, *record, None))
                    held += len(record[0])
                if len(out) >= 10_000 or held > 8 << 20:
                    yield batch()
                    out, held = [], 0
        if now is not None:
            last()
        if out:
            yield batch()

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["block", "ended", "raw"]).to_pylist(), key=lambda r: r["block"])
        record, n = form.whole(b"".join(r["raw"] for r in rows), rows[-1]["ended"])
        return pa.table({"file": table["file"][:1], "record": pa.array([record]), "n": pa.array([n], pa.int32())})

    pieces = parts(spark, path, form).withColumn("value", F.col("value").cast("binary")).mapInArrow(cut, PIECE)
    records = pieces.filter("owner is null").select("file", "record", "n")
    if by:
        records = records.unionByName(pieces.filter("owner is not null").select("file", "owner", "block", "ended", "raw").groupBy("file", "owner").applyInArrow(join, "file string, record string, n int"))
    return records, heads
