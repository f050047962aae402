"""Incremental twins of batch operators (R01-R03, R06, R08): file streams with checkpoints, AvailableNow."""

from __future__ import annotations

import json
import tempfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

EVENT = "city_code string, store_name string, seq long, name string, source string"
FOLDED = "city_code string, store_name string, seq long, name string, status string"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; only a session in one process gets its own where none is named."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where and not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return where or f"file://{tempfile.mkdtemp(prefix='promolens-')}"


def _advance(key, frames, state: GroupState):
    """The fold of one store: state holds its decisions from the last reset on, in whatever order they came."""
    kept = [tuple(e) for e in json.loads(state.get[0])] if state.exists else []
    for frame in frames:
        kept += zip(frame["seq"].astype(int).tolist(), frame["name"].tolist(), frame["source"].tolist(), strict=True)
    kept = sorted(set(kept))
    reset = max((seq for seq, name, _ in kept if not name), default=None)
    kept = [e for e in kept if reset is None or e[0] >= reset]  # what stands before a reset can't count again
    state.update((json.dumps(kept),))
    first: dict[str, int] = {}
    for seq, name, _ in kept:
        if name:
            first.setdefault(name, seq)
    rows = [(*key, seq, name, "manual_confirmed") for name, seq in first.items()]
    if not rows:
        absent = any(x in kept[-1][2].lower() for x in ("not_comp", "not_on_comp"))
        rows = [(*key, kept[-1][0], "", "not_on_comp" if absent else "manual_rejected")]
    yield pd.DataFrame(rows, columns=["city_code", "store_name", "seq", "name", "status"])


def fold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision log as a stream, folded by a state for each store; equal to the batch fold.

    A store's rows come anew with each batch that brings a decision of it, and those of its last
    batch hold. A batch is written under its own number, so replaying one after a failure replaces
    what it had written, and the checkpoint says where to go on.
    """
    from promolens.plans.bridge import load

    base = f"{shared_folder(spark)}/promolens-stream/{uuid.uuid4().hex}"
    load(spark, sf_dir, "decisions").repartition(4).write.parquet(f"{base}/in")
    log = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 2).parquet(f"{base}/in")
    folded = log.groupBy("city_code", "store_name").applyInPandasWithState(_advance, FOLDED, "kept string", "update", "NoTimeout")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    folded.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{base}/offsets").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(f"{FOLDED}, batch long").option("basePath", f"{base}/out").parquet(f"{base}/out")
    last = rows.groupBy("city_code", "store_name").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["city_code", "store_name", "batch"], "left_semi").drop("batch")


def first_seen(events: DataFrame, key: list[str], time: str, late: str = "7 days") -> DataFrame:
    """Each key once, with state bounded by the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def weekly(events: DataFrame, time: str, late: str = "1 day") -> DataFrame:
    """Counts of weeks that begin on Monday."""
    return events.withWatermark(time, late).groupBy(F.window(time, "1 week", startTime="4 days"), "event_type").agg(F.count("*").alias("n"))
