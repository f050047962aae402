"""Commands of a person on stores, in one stream, that change the mapping and settle the review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.streaming.arrival import drain, drained

KEY = ["city_code", "store_name"]
COMMAND = "city_code string, store_name string, seq long, action string, names array<string>"
#: What a person may say of a store, and the source of the rows that follow.
CONFIRM, SET, REMOVE, REJECT, ABSENT = "confirm", "set", "remove", "reject", "absent"
_ROW = "array<struct<comp_name:string,source:string>>"


def chosen(names: Column) -> Column:
    """Names without blanks at their ends, each once, in order."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda n: F.trim(n)), lambda n: n != ""))


def routed(commands: DataFrame) -> DataFrame:
    """Commands that do anything: known actions, confirmations and removals with a name at least."""
    rows = commands.select(*KEY, "seq", F.lower(F.trim("action")).alias("action"), chosen(F.col("names")).alias("names"))
    return rows.where(F.col("action").isin(SET, REJECT, ABSENT) | (F.col("action").isin(CONFIRM, REMOVE) & (F.size("names") > 0)))


def _after(state: Column, c: Column) -> Column:
    rows = lambda names: F.transform(names, lambda n: F.struct(n.alias("comp_name"), F.lit("manual_confirmed").alias("source")))
    blank = lambda source: F.array(F.struct(F.lit("").alias("comp_name"), F.lit(source).alias("source")))
    named = F.filter(state, lambda r: r["comp_name"] != "")
    others = F.filter(named, lambda r: ~F.array_contains(c["names"], r["comp_name"]))
    return (
        F.when(c["action"] == CONFIRM, F.concat(others, rows(c["names"])))  # M01: the last row of a pair stays
        .when(c["action"] == SET, rows(c["names"]))  # M02: none at all leaves the store unmatched
        .when(c["action"] == REMOVE, F.filter(state, lambda r: ~F.array_contains(c["names"], r["comp_name"])))  # M03
        .when(c["action"] == REJECT, blank("manual_rejected"))  # M04/M06
        .otherwise(blank("not_on_comp"))  # M05
    ).cast(_ROW)


def apply(mapping: DataFrame, review: DataFrame, commands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The mapping and the review queue after all commands, each store's in order of ``seq``.

    mapping: city_code, store_name, comp_name, source; review: city_code, store_name and whatever
    else. Stores without a command are not touched. A command that comes twice counts once; all but
    a removal settle the store's review.
    """
    todo = routed(commands).dropDuplicates([*KEY, "seq"])
    order = F.array_sort(F.collect_list(F.struct("seq", "action", "names")))
    told = todo.groupBy(*KEY).agg(order.alias("commands"))
    had = mapping.join(told.select(*KEY), KEY, "left_semi").groupBy(*KEY).agg(F.array_sort(F.collect_set(F.struct("comp_name", "source"))).alias("rows"))
    begin = F.coalesce(F.col("rows"), F.array().cast(_ROW)).cast(_ROW)
    after = told.join(had, KEY, "left").select(*KEY, F.explode(F.aggregate("commands", begin, _after)).alias("r")).select(*KEY, "r.comp_name", "r.source")
    settled = todo.where(F.col("action") != REMOVE).select(*KEY)
    return mapping.select(*KEY, "comp_name", "source").join(told.select(*KEY), KEY, "left_anti").unionByName(after), review.join(settled, KEY, "left_anti")


def take(stream: DataFrame, folder: str) -> None:
    """Commands that have arrived go to the log, a batch under its number, so each counts once whatever fails."""
    drain(routed(stream), folder, "append")


def log(spark: SparkSession, folder: str) -> DataFrame:
    return drained(spark, folder, COMMAND).drop("batch")
