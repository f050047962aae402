"""Quality checks on weekly results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_cities(expected: DataFrame, found: DataFrame) -> DataFrame:
    """C01."""
    return expected.join(found.select("city_code").distinct(), "city_code", "left_anti")


def count_shift(now: DataFrame, before: DataFrame, drop: float = 20.0, gain: float = 50.0) -> DataFrame:
    """Stores of each city against the week before; a drop warns, a gain informs."""
    a, b = now.groupBy("city_code").agg(F.count("*").alias("n_now")), before.groupBy("city_code").agg(F.count("*").alias("n_before"))
    out = b.join(a, "city_code", "left").withColumn("n_now", F.coalesce("n_now", F.lit(0))).withColumn("shift_pct", F.round((F.col("n_now") - F.col("n_before")) / F.col("n_before") * 100, 1))
    return out.withColumn("level", F.when(F.col("shift_pct") < -drop, "WARNING").when(F.col("shift_pct") > gain, "INFO")).where("level is not null")


def distribution(verdicts: DataFrame) -> DataFrame:
    """Shares of the verdicts over stores that are neither unmatched nor exclusive."""
    rows = verdicts.where(~F.col("parity").isin("UNMATCHED", "EXCLUSIVE_OWN"))
    share = lambda v: F.round(F.count(F.when(F.col("parity") == v, 1)) / F.count("*") * 100, 1).alias(f"pct_{v.lower()}")
    return rows.groupBy("week_num").agg(*[share(v) for v in ("SUPERIORITY", "PARITY", "INFERIORITY")])
