"""Raw extracts as frames. All reads are Spark's; users land the files unpacked."""

from __future__ import annotations

import contextlib
import csv
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import null_tokens
from ..storage import written
from . import ranges

#: Area record, as it is exported.
AREA_SCHEMA = "fips string, state string, county string, population bigint, median_hh_income bigint, rucc_2023 int, rural boolean, n_providers bigint, miles_to_nearest double, n_hospitals bigint, n_cah bigint, hpsa_primary_care boolean, disease_measure double"


def resolve(columns: Sequence[str], wanted: dict[str, Sequence[str]]) -> dict[str, str]:
    """New name to the column that has the first of its candidate names, in either case; absent ones are left out."""
    lower = {c.strip().lower(): c for c in columns}
    return {new: lower[hit.lower()] for new, names in wanted.items() if (hit := next((n for n in names if n.lower() in lower), None))}


def resolve_containing(columns: Sequence[str], wanted: dict[str, Sequence[str]]) -> dict[str, str]:
    """New name to the first column whose name contains all the given parts, in either case."""
    found = {new: next((c for c in columns if all(p.lower() in c.lower() for p in parts)), None) for new, parts in wanted.items()}
    return {new: c for new, c in found.items() if c is not None}


def renamed(df: DataFrame, names: dict[str, str], required: Sequence[str] = ()) -> DataFrame:
    """The resolved columns under their new names; raises if a required one is missing."""
    if missing := [n for n in required if n not in names]:
        raise ValueError(f"no column for {missing}; there are {df.columns[:15]}")
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in names.items()])


def read_text_table(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", skip_long_rows: bool = False, multi_line: bool = True) -> DataFrame:
    """A delimited file, or a folder of them, with headers; all columns as text, missing-value texts as null, names stripped.

    All files must have the header of the first. Quoted line ends stay within their field,
    and files are read in ranges all the same (see ``ranges``); ``multi_line=False`` leaves that out for files
    without any. ``skip_long_rows`` leaves out rows with more fields than the header has, even if what
    is too much is empty, and keeps short ones. The encoding must hold ASCII as it is. Blank lines are no rows.
    """
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": True}
    if not multi_line and not skip_long_rows:
        header = spark.read.options(header=True, encoding=encoding, **options | {"multiLine": False}).csv(path).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        # Spark holds the header of every file against these names
        rows = spark.read.options(header=True, encoding=encoding, enforceSchema=False, **options | {"multiLine": False}).schema(schema).csv(path)
        return null_tokens(rows.toDF(*[c.strip() for c in header]))
    records, heads = ranges.read_records(spark, path, ranges.Delimited(sep.encode(), encoding))
    found = heads.groupBy("head").agg(F.min("file").alias("file")).orderBy("file").limit(2).collect()
    if not found:
        raise ValueError(f"no header: {path}")
    if len(found) > 1:
        raise ValueError(f"{found[1]['file']} has the header {found[1]['head']!r}, not {found[0]['head']!r}")
    header = next(csv.reader([found[0]["head"]], delimiter=sep))
    if skip_long_rows:
        records = records.filter(F.col("n") <= len(header))
    names = [f"c{i}" for i in range(len(header))]
    fields = F.from_csv("record", ", ".join(f"{n} string" for n in names), {k: str(v) for k, v in options.items()})
    rows = records.select(fields.alias("r")).select(*[F.col(f"r.{n}").alias(n) for n in names])
    return null_tokens(rows.toDF(*[c.strip() for c in header]))


def read_json_rows(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array of arrays a file, its first row the header; all columns as text.

    The columns are those of one of the headers; each file's own header says where they are in its
    rows, and what it lacks is null. Files are read in ranges.
    """
    records, heads = ranges.read_records(spark, path, ranges.ARRAYS)
    row = lambda c: F.from_json(c, "array<string>")
    # written: one row a file, which meets all rows of the file
    heads = written(heads.select("file", row("head").alias("header")), "headers")
    first = heads.orderBy("file").select("header").first()
    if first is None:
        raise ValueError(f"no header: {path}")
    data = records.select("file", row("record").alias("r")).join(heads, "file", "left")  # each file has one
    return data.select(*[F.get("r", F.array_position("header", n).cast("int") - 1).alias(n) for n in first["header"]])


def read_registry(spark: SparkSession, path: str, wanted: dict[str, str], slots: dict[str, str], n_slots: int) -> DataFrame:
    """Provider registry: ``wanted`` new to raw names, ``slots`` new to raw name stems of the numbered columns.

    Only these columns are parsed (column pruning); Spark splits the file, so a field must not
    have a line end.
    """
    raw = read_text_table(spark, path, multi_line=False)
    numbered = {f"{new}_{i}": f"{stem}_{i}" for i in range(1, n_slots + 1) for new, stem in slots.items()}
    return renamed(raw, {n: o for n, o in (wanted | numbered).items() if o in raw.columns}, tuple(wanted))


def read_or_empty(spark: SparkSession, read, schema: str, required: Sequence[str]) -> DataFrame:
    """What ``read()`` gives, or an empty frame of ``schema`` if the source is missing or lacks columns."""
    from pyspark.errors import AnalysisException

    try:
        df = read()
    except AnalysisException:
        return spark.createDataFrame([], schema)
    return df if set(required) <= set(df.columns) else spark.createDataFrame([], schema)


def read_areas(spark: SparkSession, path: str, lines: bool = False, n: str | None = None) -> DataFrame:
    """The exported array of area records, of any size, or with ``lines`` a record on each line; records that say in ``n`` how many they stand for have that column."""
    schema = AREA_SCHEMA if n is None else f"{AREA_SCHEMA}, {n} bigint"
    if lines:
        return spark.read.schema(schema).json(path)
    records, heads = ranges.read_records(spark, path, ranges.OBJECTS)
    both = records.select("record").unionByName(heads.select(F.col("head").alias("record")))  # there is no header
    return both.select(F.from_json("record", schema).alias("r")).select("r.*")


@contextlib.contextmanager
def held_areas(spark: SparkSession, path: str, lines: bool = False) -> Iterator[DataFrame]:
    """The area records in memory, for lookups and filters that go over them again and again; let go at the end."""
    areas = read_areas(spark, path, lines).cache()
    try:
        yield areas
    finally:
        areas.unpersist()


def pushed(df: DataFrame, where: Column, columns: Sequence[str], limit: int | None = None) -> DataFrame:
    """Filter, columns and row limit given to the source."""
    df = df.filter(where).select(*columns)
    return df if limit is None else df.limit(limit)


def not_empty(df: DataFrame, what: str) -> DataFrame:
    """``df``; raises if it has no rows."""
    if df.isEmpty():
        raise ValueError(f"no rows: {what}")
    return df
