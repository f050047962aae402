"""Shared helpers: table access, shared storage and Arrow batch plumbing.

Every operator names the columns it reads, so extra columns, also with clashing
names such as ``size`` or ``score``, never reach it.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch at most, but for a single longer text.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a session in one process (tests) gets a folder of its own where none is named; on a
    cluster that would scatter tables over the machines' disks.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='promolens-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where


#: Spark's setting that frees the shuffle files of an execution when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: lineage ends, lost executors cost nothing.

    Nothing reads the shuffle files behind a table that is written, so they go with its execution.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/promolens/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialise wrote, once nothing will read them again."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def arrow_batches(spark: SparkSession) -> None:
    """Bound the rows and the bytes of the Arrow batches that the session's later plans hand to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def doc_texts(docs: DataFrame, *more) -> DataFrame:
    """doc_id and text as long and string, null text as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


#: A key counts as hot when it holds more than one in so many rows, so fewer keys than this are.
HOT = 1000


def hot_join(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Inner join of a written table with facts of one row a key, without null keys.

    Hot keys (fewer than HOT, whatever the table's size) meet their facts in a broadcast, so their
    rows stay where they are; only the others are shuffled.
    """
    least = rows.count() // HOT
    hot = materialise(rows.groupBy(key).agg(F.count("*").alias("_rows")).where(F.col("_rows") > least).select(key), "hot-keys")
    few = rows.join(F.broadcast(facts.join(F.broadcast(hot), key, "left_semi")), key)
    return few.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(facts, key))


def map_rows(df: DataFrame, fn, schema: str) -> DataFrame:
    """mapInArrow over columns as Python lists: fn(dict of lists) returns a dict of columns."""
    arrow_batches(df.sparkSession)
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    fields = [(x.split()[0], kinds[x.split()[1]]) for x in schema.split(",")]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = fn(batch.to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(out[n], kind) for n, kind in fields], [n for n, _ in fields])

    return df.mapInArrow(run, schema)


def flat_text(column) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as one byte array and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def byte_class(pattern_bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(pattern_bytes)] = True
    return out


#: Bytes that separate words of [^\x20\x09-\x0D]+.
SPACE = byte_class([0x20, *range(0x09, 0x0E)])


def spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes that do not cross rows: starts and ends."""
    if not inside.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    first = off[:-1]
    before[first[first < inside.size]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    last = off[1:] - 1
    after[last[last >= 0]] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser by shifts and odd multipliers."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x9E3779B97F4A7C15)
    x = x ^ (x >> U64(29))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """At each position the next eight bytes, little endian, zeros past the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((data.size,), "<u8", padded.data, 0, (1,))


_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, eight bytes a step over the spans that are left."""
    length = ends - starts
    out = mix(length.astype(np.uint64) + U64(0x51ED270B))
    if not starts.size:
        return out
    words, left, at = eight_bytes(data), np.arange(starts.size), starts.copy()
    remaining = length.copy()
    while True:
        live = remaining > 0
        if not live.all():
            left, at, remaining = left[live], at[live], remaining[live]
        if not left.size:
            return out
        chunk = words[at] & _KEEP[np.minimum(remaining, 8)]
        out[left] = mix(out[left] * U64(0xC2B2AE3D27D4EB4F) + mix(chunk))
        at, remaining = at + 8, remaining - 8
