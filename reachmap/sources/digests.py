"""SHA-256 of files of any size.

Small files are digested as values of the binary source. A large one is read as text
cut at line ends, its ranges in order in one task, through which the bytes stream: no value
holds more than a line, and nothing is shuffled. One file's digest is one sequence of
steps, so its bytes can't be dealt out; several large files go to as many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import written

#: Bytes from which on a file is streamed, and files that one job streams.
LARGE, AT_ONCE = 256 << 20, 64
BOM = b"\xef\xbb\xbf"
FILE = "path string, length long, sha256 string"


def _streamed(spark: SparkSession, path: str, length: int) -> DataFrame:
    """(path, length, sha256) of one file.

    The reader leaves out a byte-order mark at the start and does not say whether
    the last line has an end: two digests are carried, and the length tells which is right.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, marked, n, begun, block = hashlib.sha256(), hashlib.sha256(BOM), 0, False, -1
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = batch.column(0)
            first, last = blocks[0].as_py(), blocks[-1].as_py()
            if first < block or last < first:
                raise RuntimeError(f"the ranges of {path} came out of order")
            block = last
            text = b"\n".join(batch.column(1).to_pylist())
            data = b"\n" + text if begun else text
            plain.update(data), marked.update(data)
            n, begun = n + len(data), True
        for state, size in ((plain, n), (marked, n + len(BOM))):
            if length in (size, size + 1):
                if length == size + 1:
                    state.update(b"\n")
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([length]), pa.array([state.hexdigest()])], ["path", "length", "sha256"])
                return
        raise RuntimeError(f"{path} has {length} bytes, of which {n} were read")

    lines = spark.read.option("lineSep", "\n").text(path)
    # ranges of one file are in order, and one task reads them in that order
    return lines.select(F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line")).coalesce(1).mapInArrow(digest, FILE)


def file_digests(spark: SparkSession, path: str, pattern: str = "*", large: int = LARGE) -> DataFrame:
    """(path, length, sha256) of the files below ``path`` whose names fit ``pattern``; Spark lists no files without bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    small = files.filter(F.col("length") < large).select("path", "length", F.sha2("content", 256).alias("sha256"))
    # the number of large files is that of the bytes, divided by ``large``
    found = [(r.path, r.length) for r in files.filter(F.col("length") >= large).select("path", "length").collect()]
    rounds = [found[k : k + AT_ONCE] for k in range(0, len(found), AT_ONCE)]
    done = [written(reduce(DataFrame.unionByName, [_streamed(spark, p, n) for p, n in some]), "digests") for some in rounds]
    return reduce(DataFrame.unionByName, done, small)
