"""Where the operators keep intermediate tables.

Tables cut the lineage between the steps of an iterative or multi-step job. They
go to the folder the cluster names in ``spark.checkpoint.dir``, which every
executor can read, so a lost executor costs a re-read and not a re-run. ``run`` removes those
of a whole run.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; without one, a folder of our own if all runs in one process, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


#: Paths that this driver has given out and not removed.
_given: list[str] = []


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    _given.append(f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}")
    return _given[-1]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can reach it; nothing happens if it isn't there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def run(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables of what is done inside are removed at the end; results must be written elsewhere by then."""
    before = len(_given)
    try:
        yield
    finally:
        while len(_given) > before:
            remove(spark, _given.pop())


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
