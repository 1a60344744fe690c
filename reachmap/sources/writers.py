"""Writers of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import null_if_nan
from ..storage import written


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Zstandard Parquet in place of what was there."""
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def json_row(df: DataFrame) -> Column:
    """A row as compact JSON, nulls written out, NaN as null."""
    fields = [null_if_nan(F.col(n)).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def json_rows(df: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, json, *keep) for each row, whose JSON is without ``keep``; write it as text for JSON lines of any size."""
    return df.select(key, json_row(df.drop(*keep)).alias("json"), *keep)


#: Bits of the number of lines that are put together as one text.
RUN = 10


def write_json_array(df: DataFrame, key: str, path: str, n: str | None = None, compression: str = "none") -> None:
    """One JSON array of all rows sorted by ``key``, as text files that give the array if they are read one after the other, by name.

    Rows go out by ranges of the key, each with the mark before it: the bracket before the first
    row, commas before the others; the last one closes the array. Equal rows are counted before
    they are dealt out, and come one after the other; rows of one key go by their text. A table without
    rows gives ``[]``. A row stands for ``n`` equal ones if it has that column, which is not written. Compressed
    files, whose equal lines take little room, give the array if they are unpacked.
    """
    # written: its least and greatest row are asked for before it is dealt out
    rows = written(df.groupBy(F.col(key).alias("k"), json_row(df.drop(n) if n else df).alias("j")).agg(F.sum(F.col(n) if n else F.lit(1)).alias("n")), "json-rows")
    ends = rows.agg(F.min(F.struct("k", "j")).alias("a"), F.max(F.struct("k", "j", "n")).alias("z")).first()
    if ends.a is None:
        df.sparkSession.range(1).select(F.lit("[]").alias("value")).coalesce(1).write.mode("overwrite").option("compression", compression).text(path)
        return
    # lines of equal rows are put together in runs, a text each
    runs = rows.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, RUN))))
    left = F.col("n") - F.shiftleft("run", RUN)
    same = lambda r: F.col("k").eqNullSafe(F.lit(r.k)) & (F.col("j") == r.j)
    first, last = same(ends.a) & (F.col("run") == 0), same(ends.z) & (left <= 1 << RUN)
    others = F.repeat(F.concat(F.lit("\n,"), "j"), (F.least(left, F.lit(1 << RUN)) - 1).cast("int"))
    text = F.concat(F.when(first, "[").otherwise(","), "j", others, F.when(last, "]").otherwise(""))
    order = ["k", "j", "run"]
    runs.repartitionByRange(*order).sortWithinPartitions(*order).select(text.alias("value")).write.mode("overwrite").option("compression", compression).text(path)


def write_reports(reports: DataFrame, path: str) -> None:
    """Report rows by state, so that one area's report is read from one folder."""
    write_table(reports, path, ("state",))
