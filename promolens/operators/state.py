"""Keyed state: upserts, retention, decision logs and mapping commands."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, key: list[str], order: str, last: bool = True) -> DataFrame:
    """The last (or first) row of each key by an explicit ordinal."""
    cols = [c for c in df.columns if c not in key]
    pick = (F.max_by if last else F.min_by)(F.struct(*cols), F.col(order))
    return df.groupBy(*key).agg(pick.alias("x")).select(*key, "x.*")


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """Rows of the new table replace those of the same key; its last row wins."""
    fresh = keep_one(new, key, order)
    return old.join(fresh, key, "left_anti").unionByName(fresh, allowMissingColumns=True)


def replace_partitions(old: DataFrame, new: DataFrame, part: str) -> DataFrame:
    """All rows of the partitions that arrive are replaced."""
    return old.join(new.select(part).distinct(), part, "left_anti").unionByName(new, allowMissingColumns=True)


def retain_last(df: DataFrame, part: str, keep: int) -> DataFrame:
    """The greatest ``keep`` values of a partition column; their list is a bounded top-k."""
    return df.join(F.broadcast(df.select(part).distinct().orderBy(F.desc(part)).limit(keep)), part, "left_semi")


def fold_log(log: DataFrame, key: list[str]) -> DataFrame:
    """Decisions in order; a blank name resets, names after the last reset stay, each once.

    A key that ends in a reset is one blank row: absent from the other side if the last decision's
    source says so, else rejected.
    """
    rows = log.withColumn("reset", F.max(F.when(F.col("name") == "", F.col("seq"))).over(Window.partitionBy(*key)))
    named = rows.where("name <> '' and seq > coalesce(reset, -1)").groupBy(*key, "name").agg(F.min("seq").alias("seq"))
    named = named.withColumn("status", F.lit("manual_confirmed"))
    absent = F.lower("source").contains("not_comp") | F.lower("source").contains("not_on_comp")
    blank = rows.groupBy(*key).agg(F.max("seq").alias("seq"), F.max("reset").alias("reset"), F.max_by("source", "seq").alias("source")).where("seq = reset")
    return named.unionByName(blank.select(*key, F.lit("").alias("name"), "seq", F.when(absent, "not_on_comp").otherwise("manual_rejected").alias("status")))


def merge_log(mapping: DataFrame, folded: DataFrame) -> DataFrame:
    """Folded decisions replace mapping rows of their stores, but for what was rejected before."""
    key = ["city_code", "store_name"]
    kept = mapping.join(folded.select(*key).distinct().withColumn("hit", F.lit(True)), key, "left").where("hit is null or source = 'manual_rejected'").drop("hit")
    fresh = folded.join(mapping.where("source = 'manual_rejected'").select(*key).distinct(), key, "left_anti")
    return kept.unionByName(fresh.select(*key, F.col("name").alias("comp_name"), F.col("status").alias("source")))


def upsert_sheet(old: DataFrame, new: DataFrame, key: list[str], order: str, part: str | None = None, keep: int = 6) -> DataFrame:
    """Rows of the incoming partitions, or else of the incoming keys, are replaced; columns are
    united; where a partition column is given, only its greatest ``keep`` values stay."""
    fresh = keep_one(new, key, order)
    on = [part] if part else key
    out = old.join(fresh.select(*on).distinct(), on, "left_anti").unionByName(fresh, allowMissingColumns=True)
    return retain_last(out, part, keep) if part else out


def confirm(mapping: DataFrame, commands: DataFrame) -> DataFrame:
    """Negatives of the commanded stores go, the positive is there once."""
    key = ["city_code", "store_name"]
    hit = commands.select(*key).distinct().withColumn("hit", F.lit(True))
    kept = mapping.join(hit, key, "left").where("hit is null or comp_name <> ''").drop("hit")
    return kept.join(commands, [*key, "comp_name"], "left_anti").unionByName(commands)


def set_matches(mapping: DataFrame, commands: DataFrame) -> DataFrame:
    """All rows of the commanded stores are replaced."""
    return mapping.join(commands.select("city_code", "store_name").distinct(), ["city_code", "store_name"], "left_anti").unionByName(commands)


def remove_match(mapping: DataFrame, commands: DataFrame) -> DataFrame:
    """M03."""
    return mapping.join(commands, ["city_code", "store_name", "comp_name"], "left_anti")


def reject(mapping: DataFrame, keys: DataFrame, source: str = "manual_rejected") -> DataFrame:
    """The commanded stores get one blank row; other stores stay as they are."""
    blank = keys.select("city_code", "store_name").distinct().withColumns({"comp_name": F.lit(""), "source": F.lit(source)})
    return set_matches(mapping, blank)
