"""Lineage, snapshots, and picking one of many."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..storage import written

# Month names, in order.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``: one aggregate of the greatest struct, no sort."""
    rest = [c for c in rows.columns if c not in {*keys, *order}]
    return rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__last")).select(*keys, *[F.col(f"__last.{c}").alias(c) for c in (*order, *rest)])


def upsert(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``table`` without the keys of ``new``, and ``new``."""
    return table.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


#: Parts of a table that upserts rewrite alone.
BUCKETS = 256


def bucket_of(keys: list[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def create_buckets(table: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Write ``table`` so that ``upsert_buckets`` can replace parts of it: a folder for each bucket of the keys."""
    _write_buckets(table.withColumn("bucket", bucket_of(keys, buckets)), path)


def upsert_buckets(new: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Put ``new`` in place of the rows of its keys, and beside the others; only buckets that have a key of ``new`` are read and written.

    The new buckets are complete in the shared folder before the old ones are replaced, and a
    second run with the same rows gives the same table: after a failure it is run again.
    """
    spark = new.sparkSession
    new = written(new.withColumn("bucket", bucket_of(keys, buckets)), "upsert-new")
    touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # ``buckets`` numbers at most
    if not touched:
        return
    old = spark.read.parquet(path).filter(F.col("bucket").isin(touched)).select(*new.columns)
    # a null key takes the place of a null key: else a second run would add it again
    same = reduce(Column.__and__, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in ("bucket", *keys)])
    kept = old.alias("o").join(new.select("bucket", *keys).distinct().alias("n"), same, "left_anti")
    _write_buckets(written(kept.unionByName(new), "upsert"), path)


def _write_buckets(rows: DataFrame, path: str) -> None:
    rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("bucket").parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def manifest(files: DataFrame, script: str, source: str, base: str, fetched_at: Column) -> DataFrame:
    """Lineage rows of files (path, length, sha256), see ``file_digests``."""
    return files.select(
        F.lit(script).alias("script"), F.lit(source).alias("source"), F.col("path").alias("url"), F.regexp_replace("path", f"^.*?{base}/?", "").alias("local_path"),
        "sha256", F.col("length").alias("bytes"), fetched_at.alias("fetched_at"),
    )


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, change) of rows that were added, removed or changed."""
    side = lambda df, name: df.select(key, F.struct(*columns).alias(name))
    joined = side(old, "was").join(side(new, "is"), key, "full")
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").when(~F.col("was").eqNullSafe(F.col("is")), "changed")
    return joined.select(key, change.alias("change")).filter("change is not null")


#: Bits of a key's hash that pick its bucket at each level of ``snapshot_diff_by_digests``.
LEVELS = (8, 16, 24)


def _digests(rows: DataFrame, bits: int, columns: list[str]) -> DataFrame:
    """(bucket, digest) by the leading bits of ``hash``: number, sum and exclusive-or of the rows' hashes, which no order changes."""
    own = F.xxhash64("hash", *columns)
    again = F.xxhash64(own, F.lit("again"), *columns)
    return rows.groupBy(F.shiftrightunsigned("hash", 64 - bits).alias("bucket")).agg(F.struct(F.count(F.lit(1)).alias("n"), F.bit_xor(own).alias("x"), F.sum(again.cast("decimal(20,0)")).alias("s")).alias("digest"))


def snapshot_diff_by_digests(old: DataFrame, new: DataFrame, key: str, columns: list[str], levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """``snapshot_diff`` of large snapshots that differ in little.

    Each level compares digests of the buckets that the level before found different, by more
    bits of the key's hash; only rows of buckets that differ at the last level are joined.
    Equal snapshots shuffle 2^bits digests of the first level and no row. Two different buckets have the same
    digest with a probability of about 2^-128.
    """
    sides = [df.select(key, *columns).withColumn("hash", F.xxhash64(key)) for df in (old, new)]
    differ = None
    for bits in levels:
        if differ is not None:
            sides = [side.join(differ, F.shiftrightunsigned("hash", 64 - before).eqNullSafe(F.col("bucket")), "left_semi") for side in sides]
        a, b = (_digests(side, bits, columns).alias(name) for side, name in zip(sides, ("a", "b"), strict=True))
        joined = a.join(b, F.col("a.bucket") == F.col("b.bucket"), "full").filter(~F.col("a.digest").eqNullSafe(F.col("b.digest")))
        differ, before = written(joined.select(F.coalesce("a.bucket", "b.bucket").alias("bucket")), "buckets"), bits
        if differ.isEmpty():
            break
    sides = [side.join(differ, F.shiftrightunsigned("hash", 64 - before).eqNullSafe(F.col("bucket")), "left_semi") for side in sides]
    return snapshot_diff(*sides, key, columns)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames hold the same rows."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def observed(df: DataFrame, name: str, **flags: Column) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its rows, and of those where each flag holds; filled by the next action over it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(flag).alias(n) for n, flag in flags.items()]), seen


def grouped(df: DataFrame, n: str = "n") -> DataFrame:
    """The distinct rows of ``df``, each with ``n``, how often it is there."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(n))


def counted(df: DataFrame, name: str | None = None, **flags: Column) -> DataFrame | tuple[DataFrame, Observation]:
    """The one name for both counts: with the name of an observation ``observed``, else ``grouped``."""
    if name is not None:
        return observed(df, name, **flags)
    if flags:
        raise TypeError("flags are counted by an observation, which has a name")
    return grouped(df)


#: Bits of the number of copies that are made from one row in one go, and of those in the shortest loop.
RUN, LOOP = 13, 8


def expanded(df: DataFrame, n: str = "n", dealt: bool = False) -> DataFrame:
    """Each row as often as ``n`` says (null: once), without ``n``: the inverse of ``grouped``. Copies follow each other, so a sorted table stays sorted.

    ``dealt``: the copies of a row are made by many tasks, in runs, and in no order; for rows that stand for very many.
    """
    runs = _parts(df.withColumn(n, F.coalesce(n, F.lit(1).cast("long"))), n, RUN)
    if dealt:
        # a number of its own: Spark would join partitions by their bytes, which say nothing of the copies
        runs = runs.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *[c for c, kind in runs.dtypes if not kind.startswith("map")])
    loops = _parts(runs.drop("_part"), n, LOOP).drop("_part")
    return loops.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), F.col(n).cast("int")))).drop(n, "_copy")


def _parts(df: DataFrame, n: str, bits: int) -> DataFrame:
    """Each row in parts of 2^bits copies at most: ``n`` of that part, and its number ``_part``."""
    parts = df.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col(n) - 1, bits))))
    return parts.withColumn(n, F.least(F.lit(1 << bits).cast("long"), F.col(n) - F.shiftleft("_part", bits)))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def links(pages: DataFrame, key: str, html: str, pattern: str = r'href="([^"]*)"') -> DataFrame:
    """(key, link): every distinct link of each key's pages."""
    return pages.select(key, F.explode(F.regexp_extract_all(html, F.lit(pattern), F.lit(1))).alias("link")).distinct()


#: Fixed value: how an artifact is named by month, year and version.
ARTIFACT_NAME = r"_([A-Za-z]+)_(\d{4})(?:_V(\d+))?\.zip$"


def artifact_order(name: Column) -> Column:
    """(year, month, version) of ``.._Month_2024_V2.zip``; zeros where the name has another form."""
    part = lambda i: F.regexp_extract(name, ARTIFACT_NAME, i)
    month = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m, i)]), part(1)), F.lit(0))
    number = lambda i: F.coalesce(part(i).try_cast("int"), F.lit(0))
    return F.struct(number(2).alias("year"), F.when(number(2) > 0, month).otherwise(0).alias("month"), number(3).alias("version"))


def latest_artifact(found: DataFrame, link: str = "link", leave_out: str = "Weekly", base: str = "", group: tuple[str, ...] = ()) -> DataFrame:
    """(*group, link): the latest artifact of each group by its name, resolved against ``base``."""
    kept = found.filter(~F.col(link).contains(leave_out))
    last = kept.groupBy(*group).agg(F.max_by(link, F.struct(artifact_order(F.col(link)), F.col(link))).alias("link"))
    absolute = F.when(F.col("link").startswith("http"), F.col("link")).otherwise(F.concat(F.lit(base), F.regexp_replace("link", r"^[./]+", "")))
    return last.select(*group, absolute.alias("link"))


def largest_match(rows: DataFrame, group: str, name: Column, include: str, exclude: str, size: str, tie: str) -> DataFrame:
    """Per group the row of the greatest ``size`` whose name has one text and not the other; the least ``tie`` among equals."""
    kept = rows.filter(F.lower(name).contains(include) & ~F.lower(name).contains(exclude))
    rest = [c for c in rows.columns if c not in (group, size, tie)]
    best = kept.groupBy(group).agg(F.min(F.struct((-F.col(size)).alias("__less"), tie, *rest, size)).alias("best"))
    return best.select(group, *[F.col(f"best.{c}").alias(c) for c in (tie, *rest, size)])


def first_match_of_rows(rows: DataFrame, key: str, order: str, fits: Column, value: str, out: str, n: str) -> DataFrame:
    """Per key the value of the first row that fits, and the number of rows: the same choice where the elements are rows, which are not gathered."""
    return rows.groupBy(key).agg(F.min_by(F.when(fits, F.col(value)), F.when(fits, F.col(order))).alias(out), F.count(F.lit(1)).cast("int").alias(n))


def first_match(items: Column, fits, fields) -> Column:
    """Value of the first array element that fits; ``fields`` gives the candidates in order of preference."""
    return F.coalesce(*fields(F.get(F.filter(items, fits), F.lit(0))))
