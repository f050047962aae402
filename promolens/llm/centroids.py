"""Centroid clustering by weighted deduplication: Lloyd's rounds in whole numbers on distinct vectors."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import arrow_batches, hot_join, materialise

WIDTH, SCALE, CENTROIDS, ROUNDS, SEED = 64, 256, 40, 5, 2
#: Components up to this size have squared distances that 64-bit floats hold exactly; larger ones go by Python's whole numbers.
EXACT = 1 << 21
MOST_LONG = 2**63 - 1


def quantised(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """vec_id and q of each vector with exactly ``width`` components, none null or non-finite."""
    e = F.col("embedding")
    fine = (F.size(e) == width) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    q = F.transform(e, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e).where(F.coalesce(fine, F.lit(False))).select("vec_id", q.alias("q"))


def vector_key(q: Column) -> Column:
    return F.sha2(F.concat_ws(",", q.cast("array<string>")), 256)


def first_centroids(kept: DataFrame, count: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The vectors of the ``count`` smallest hashes of ``seed:vec_id``, in their order; ties by the vector."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = kept.where("vec_id is not null").select(h.alias("h"), "q").orderBy("h", "q").limit(count).collect()  # a fixed number of rows
    return [list(r["q"]) for r in found]


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1)


def nearest(vectors: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, list[int] | np.ndarray]:
    """For each vector the number of the nearest centroid (ties: the smaller) and the squared distance, exactly."""
    largest = max((abs(x) for c in centroids for x in c), default=0)
    small = (np.abs(vectors.astype(float)).max(1, initial=0) <= EXACT) & (largest <= EXACT)
    which, far = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), object)
    if small.any():
        x, c = vectors[small].astype(float), np.array(centroids, float)
        d = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]
        which[small] = d.argmin(1)
        far[small] = d.min(1).astype(np.int64)
    for k in np.flatnonzero(~small):
        d = [sum((int(x) - y) ** 2 for x, y in zip(vectors[k], c, strict=True)) for c in centroids]
        which[k] = min(range(len(d)), key=d.__getitem__)
        far[k] = min(d)
    return which, far


def weighted_sums(distinct: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Of each centroid that has vectors: how many, and the sum of each component, exactly.

    A task sums its own; what is shuffled is a row a centroid and task, what reaches the driver a
    row a centroid.
    """
    arrow_batches(distinct.sparkSession)
    width = len(centroids[0])

    def run(batches):
        count, total = [0] * len(centroids), [[0] * width for _ in centroids]
        for batch in batches:
            if not batch.num_rows:
                continue
            q, n = _matrix(batch.column("q")), batch.column("n").to_numpy()
            which, _ = nearest(q, centroids)
            safe = float(np.abs(q.astype(float)).max(initial=0)) * float(n.sum()) < 2**62
            for k in np.unique(which):
                some = which == k
                part = (q[some] * n[some, None]).sum(0) if safe else (q[some].astype(object) * n[some, None].astype(object)).sum(0)
                count[k] += int(n[some].sum())
                total[k] = [x + int(y) for x, y in zip(total[k], part, strict=True)]
        used = [k for k in range(len(centroids)) if count[k]]
        sums = pa.array([[str(x) for x in total[k]] for k in used], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([count[k] for k in used], pa.int64()), sums], ["k", "n", "s"])

    parts = distinct.select("q", "n").mapInArrow(run, "k int, n long, s array<string>")
    whole = parts.groupBy("k").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)])
    return {r["k"]: (r["n"], [int(r[f"s{i}"]) for i in range(width)]) for r in whole.collect()}  # a row a centroid


def moved(centroids: list[list[int]], sums: dict[int, tuple[int, list[int]]]) -> list[list[int]]:
    return [[s // sums[k][0] for s in sums[k][1]] if k in sums else c for k, c in enumerate(centroids)]


def assigned(distinct: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """key, n, cluster and distance of each distinct vector; a distance beyond a long is the largest long."""
    arrow_batches(distinct.sparkSession)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                which, far = nearest(_matrix(batch.column("q")), centroids)
                far = pa.array([min(int(x), MOST_LONG) for x in far], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n"), pa.array(which.astype(np.int32)), far], ["key", "n", "cluster", "distance"])

    return distinct.select("key", "n", "q").mapInArrow(run, "key string, n long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """Operator: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each vector that is kept.

    Equal quantised vectors are one row with a multiplicity, so copies cost nothing in the rounds.
    Fewer kept vectors than ``count`` make as many centroids. Vectors of another width, with a
    null or a non-finite component, or null themselves give no row; a null vec_id is clustered but
    never a first centroid (without any other id there are no centroids and no rows); repeated ids
    are rows of their own, and each may be a first centroid; an empty table gives no rows.
    Components beyond a long are held at its ends, so are sums of distances.
    """
    spark = vectors.sparkSession
    kept = quantised(vectors, width, scale)
    centroids = first_centroids(kept, count, seed)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        return spark.createDataFrame([], schema)
    key = vector_key(F.col("q"))
    distinct = materialise(kept.groupBy("q").agg(F.count("*").alias("n")).withColumn("key", key), "cl-distinct")
    for _ in range(rounds):
        centroids = moved(centroids, weighted_sums(distinct, centroids))
    found = materialise(assigned(distinct, centroids), "cl-assigned")
    by_cluster = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)") * F.col("n")).alias("i")).collect()  # a row a centroid
    held = lambda x: min(int(x), MOST_LONG)
    total = held(sum(int(r["i"]) for r in by_cluster))
    named = [(r["cluster"], held(r["i"]), total, hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()) for r in by_cluster]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    rows = materialise(kept.select("vec_id", key.alias("key")), "cl-rows")
    return hot_join(rows, found.drop("n"), "key").join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
