"""Merge runs. A table of facts that any run, run again, leaves as it is."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.streaming.arrival import drain

FACT = "city_code string, store_name string, kind string, value string, seq long, part int, ts timestamp"
KEY = ("city_code", "store_name", "kind", "value")


def facts(rows: DataFrame) -> DataFrame:
    """What listing rows say, a row for each promotion and address of a store with its first place and last time.

    Facts of facts are the same facts, so runs may overlap, repeat, or stop half way.
    """
    parts = F.transform(F.split("promotion", r"\|"), lambda p, k: F.struct(F.lit("promotion").alias("kind"), F.regexp_replace(F.trim(p), r"\s+", " ").alias("value"), k.alias("part")))
    address = F.array(F.struct(F.lit("url").alias("kind"), F.trim("url").alias("value"), F.lit(0).alias("part")))
    named = F.filter(parts, lambda x: x["value"] != "")
    # an address counts only where the row tells a promotion
    said = F.when(F.size(named) > 0, F.concat(named, F.filter(address, lambda x: x["value"] != "")))
    each = rows.select("city_code", "store_name", F.explode(said).alias("x"), "seq", "ts").select("city_code", "store_name", "x.kind", "x.value", "seq", "x.part", "ts")
    return folded(each)


def folded(some: DataFrame) -> DataFrame:
    out = some.groupBy(*KEY).agg(F.min(F.struct("seq", "part")).alias("place"), F.max("ts").alias("ts"))
    return out.select(*KEY, "place.seq", "place.part", "ts")


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def merge_run(stream: DataFrame, table: str, run: str, folder: str) -> None:
    """Reprocess a stream of listing rows into a table that keeps what it has.

    A run has a name and a folder of checkpoints of its own; a fresh one reads the stream from its
    start. Batches are written under the run and their number, so one that fails half way is
    replaced when it is run again, and rows that another run has written fold away.
    """

    def keep(batch: DataFrame, number: int) -> None:
        facts(batch).write.mode("overwrite").parquet(f"{table}/run={run}/batch={number}")

    drain(stream, folder, "append", keep)


def read_facts(spark: SparkSession, table: str) -> DataFrame:
    fs, path = _file_system(spark, table)
    if not fs.exists(path):
        return spark.createDataFrame([], FACT)
    return spark.read.schema(FACT).option("recursiveFileLookup", "true").parquet(table)


def compact(spark: SparkSession, table: str) -> None:
    """All runs as one. Old ones go when the new one is whole, and until then count twice, which changes nothing."""
    fs, path = _file_system(spark, table)
    old = [s.getPath() for s in fs.listStatus(path)]
    folded(read_facts(spark, table)).write.parquet(f"{table}/run=compact-{uuid.uuid4().hex}/batch=0")
    for p in old:
        fs.delete(p, True)


def listing_of(some: DataFrame) -> DataFrame:
    """city_code, store_name, promotions in order of appearance, the first address and the last time, from facts."""
    promotions = F.array_sort(F.collect_list(F.when(F.col("kind") == "promotion", F.struct("seq", "part", "value"))))
    url = F.min_by(F.when(F.col("kind") == "url", F.col("value")), F.when(F.col("kind") == "url", F.col("seq")))
    out = folded(some).groupBy("city_code", "store_name").agg(promotions.alias("x"), F.coalesce(url, F.lit("")).alias("url"), F.max("ts").alias("last_seen"))
    return out.select("city_code", "store_name", F.array_join(F.col("x.value"), " | ").alias("promotions"), "url", "last_seen")
