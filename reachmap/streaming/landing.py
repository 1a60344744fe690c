"""The registry projection behind a stream: new files in, chosen providers out.

Filter and code choice have no state, so the batch function is used unchanged.
``land_latest`` adds the newest row of each key in a micro-batch as a delta, and
``latest`` reads the newest over all deltas; no batch touches what others wrote.
``compact`` makes one delta of those so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.assign import providers
from ..operators.records import latest_per_key
from ..sources.writers import write_table
from ..storage import remove, written


def stream_providers(spark: SparkSession, path: str, schema: str, codes: list[str], slots: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Streaming frame of (npi, code, zip5, *keep) over Parquet files that land in ``path``."""
    return providers(spark.readStream.schema(schema).parquet(path), codes, slots, keep=keep)


def land(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append every micro-batch to ``table``, once, until no new file is left."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(table)


def land_latest(stream: DataFrame, table: str, checkpoint: str, keys: list[str], order: list[str]) -> StreamingQuery:
    """Write the last row of each key of every micro-batch, by ``order``, to a folder of its own in ``table``.

    A batch that is run again after a failure replaces its own folder.
    """

    def delta(batch: DataFrame, epoch: int) -> None:
        write_table(latest_per_key(batch, keys, order), f"{table}/epoch={epoch}")

    return stream.writeStream.foreachBatch(delta).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, table: str, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key over all deltas; rows of equal order go by the batch they came with."""
    return latest_per_key(spark.read.parquet(table).withColumn("epoch", F.col("epoch").cast("bigint")), keys, [*order, "epoch"]).drop("epoch")


def compact(spark: SparkSession, table: str, keys: list[str], order: list[str]) -> None:
    """Replace all deltas but the last by their newest rows, which go into the last one's place.

    Run it while no stream writes. What it writes is complete before a folder goes, and after a failure at
    any point ``latest`` gives the same rows and it can run again.
    """
    epochs = sorted(r.epoch for r in spark.read.parquet(table).select(F.col("epoch").cast("bigint").alias("epoch")).distinct().collect())  # one row a batch
    if len(epochs) < 2:
        return
    write_table(written(latest(spark, table, keys, order), "compacted"), f"{table}/epoch={epochs[-1]}")
    for epoch in epochs[:-1]:
        remove(spark, f"{table}/epoch={epoch}")
