"""Streams of files: tables dealt out in order of arrival, drained with checkpoints, and read as they arrived."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.streaming.fold import shared_folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/promolens-stream/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the time of a block; two underscores in a name stand for a dot."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def arrivals(table: DataFrame, order: str, folder: str, slices: int = 8) -> DataFrame:
    """A table as a stream: ``slices`` equal ranges of a numeric column, written one after the other.

    Within a range rows come in no order, as from many writers; a later range never comes first.
    """
    spark = table.sparkSession
    low, high = table.agg(F.min(order), F.max(order)).first()
    step = ((high or 0) - (low or 0)) // slices + 1
    for k in range(slices):
        first = (low or 0) + k * step
        table.where((F.col(order) >= first) & (F.col(order) < first + step)).write.mode("append").parquet(folder)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 4).parquet(folder)


def drain(stream: DataFrame, folder: str, mode: str, keep: Callable[[DataFrame, int], None] | None = None) -> None:
    """Run a stream over all that has arrived; its batches are written under their numbers, or go to ``keep``.

    A batch that is run again after a failure replaces what it had written.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB):
        stream.writeStream.outputMode(mode).foreachBatch(keep or write).option("checkpointLocation", f"{folder}/offsets").trigger(availableNow=True).start().awaitTermination()


def drained(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """What drain has written, with the number of the batch; no rows where no batch ever ran."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/out")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], f"{schema}, batch long")
    return spark.read.schema(f"{schema}, batch long").option("basePath", f"{folder}/out").parquet(f"{folder}/out")
