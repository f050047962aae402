"""Publishing tables with errors kept apart, rebuilding them from archives, and the week's report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.operators.retention import prune_versions
from promolens.operators.state import upsert_sheet

# Days after which a file is old, points of a shift and percent of a drop or gain that count.
OLD_DAYS, SHIFT, DROP, GAIN = 8, 15.0, 20.0, 50.0
REPORT = "level string, check string, city_code string, message string"
# Key, replaced partition and weeks kept of each published table.
MATRIX = {
    "store_parity": (["city_code", "store_name", "week_num"], "week_num", 8),
    "store_parity_prime": (["city_code", "store_name", "week_num"], "week_num", 8),
    "city_parity": (["city_code", "week_num"], None, 0),
    "city_parity_prime": (["city_code", "week_num"], None, 0),
    "store_mapping": (["city_code", "store_name"], None, 0),
    "needs_review": (["city_code", "store_name"], None, 0),
    "own_products": (["city_code", "store_name", "week_num", "product_name"], "week_num", 6),
    "comp_products": (["city_code", "restaurant_name", "week_num", "product_name"], "week_num", 6),
    "priority_actions": (["city_code", "store_name", "week_num"], "week_num", 6),
    "pipeline_health": (["week_num", "check"], "week_num", 6),
    "managers": (["city_code", "store_name"], None, 0),
}


def append_rows(df: DataFrame, path: str) -> None:
    """Rows at the end of a log, with the time of writing."""
    df.withColumn("updated_at", F.current_timestamp()).write.mode("append").parquet(path)


def publish(spark: SparkSession, tables: dict[str, DataFrame], folder: str, order: str = "seq") -> DataFrame:
    """Merge each table into its published copy by MATRIX; one that fails doesn't stop the others.

    Returns (name, rows, status), rows -1 for a failure. The new copy is written beside the old one
    and counted before the name points to it; versions older than the last few go.
    """
    out = []
    for name, new in tables.items():
        try:
            key, part, keep = MATRIX[name]
            marker = f"{folder}/{name}"
            number = latest_version(spark, marker)
            old = spark.read.parquet(f"{marker}/v={number}") if number >= 0 else new.limit(0)
            merged = upsert_sheet(old, new, key, order, part, keep)
            merged.write.mode("overwrite").parquet(f"{marker}/v={number + 1}")
            out.append((name, spark.read.parquet(f"{marker}/v={number + 1}").count(), "ok"))
            prune_versions(spark, marker)
        except Exception as fault:  # noqa: BLE001  the others go on, this one is reported
            if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
                raise  # no table's fault
            out.append((name, -1, f"{type(fault).__name__}: {str(fault).splitlines()[0][:200]}"))
    return spark.createDataFrame(out, "name string, rows long, status string")


def latest_version(spark: SparkSession, marker: str) -> int:
    """The greatest version of a published table that was written whole, -1 for none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(marker)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return -1
    whole = [s.getPath() for s in fs.listStatus(path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return max((int(p.getName().removeprefix("v=")) for p in whole), default=-1)


def read_published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}/v={latest_version(spark, f'{folder}/{name}')}")


def repair(spark: SparkSession, status: DataFrame, again: Callable[[str], DataFrame], folder: str) -> DataFrame:
    """Tables that failed are made anew and published once more."""
    failed = [r["name"] for r in status.where("rows < 0").select("name").collect()]  # as many as there are tables
    return publish(spark, {name: again(name) for name in failed}, folder)


def rebuild(archives: DataFrame, like: DataFrame, weeks: list[str] | None = None) -> DataFrame:
    """Archived weeks with the columns of the table they belong to, missing ones NULL."""
    rows = archives.where(F.col("week_num").isin(*weeks)) if weeks else archives
    return rows.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in like.schema])


def weeks_of(df: DataFrame) -> DataFrame:
    """The rows of each week, to verify by."""
    return df.groupBy("week_num").agg(F.count("*").alias("n"))


def week_before(df: DataFrame, week: str) -> DataFrame:
    """The greatest week before another one."""
    return df.where(F.col("week_num") < week).agg(F.max("week_num").alias("week_num"))


def count_report(now: DataFrame, before: DataFrame) -> DataFrame:
    """Stores of each city against the week before, and one row that all is stable if none dropped."""
    a, b = now.groupBy("city_code").agg(F.count("*").alias("n")), before.groupBy("city_code").agg(F.count("*").alias("m"))
    rows = b.join(a, "city_code", "left").withColumn("pct", (F.coalesce("n", F.lit(0)) - F.col("m")) / F.col("m") * 100)
    level = F.when(F.col("pct") < -DROP, "WARNING").when(F.col("pct") > GAIN, "INFO")
    found = rows.withColumn("level", level)
    said = F.format_string("%d -> %d (%s%%)", "m", F.coalesce("n", F.lit(0)), F.round("pct", 0).cast("long").cast("string"))
    stable = found.agg(F.count(F.when(F.col("level") == "WARNING", 1)).alias("w")).where("w = 0").select(F.lit("INFO").alias("level"), F.lit("store_count_delta").alias("check"), F.lit("").alias("city_code"), F.lit("stable").alias("message"))
    return found.where("level is not null").select("level", F.lit("store_count_delta").alias("check"), "city_code", said.alias("message")).unionByName(stable)


def shift_report(now: DataFrame, before: DataFrame) -> DataFrame:
    """C03 for two tables of verdicts."""
    both = now.select("parity", F.lit("now").alias("week_num")).unionByName(before.select("parity", F.lit("before").alias("week_num")))
    return week_shift(both, "now", "before")


def week_shift(verdicts: DataFrame, now: str, before: str) -> DataFrame:
    """A share of inferior verdicts that rose by more than SHIFT points warns; else the shares are
    told. Both weeks come from one pass over the verdicts."""
    week, parity = F.col("week_num"), F.col("parity")
    count = lambda w, *said: F.count(F.when((week == w) & (parity.isin(*said) if said else F.lit(True)), 1))
    share = lambda w, v, p: (F.try_divide(count(w, v), count(w)) * 100).alias(p)
    rows = verdicts.where(week.isin(now, before) & ~parity.isin("UNMATCHED", "EXCLUSIVE_OWN"))
    one = rows.agg(count(now).alias("n"), count(before).alias("m"), share(now, "INFERIORITY", "inf"), share(now, "SUPERIORITY", "sup"), share(now, "PARITY", "par"), share(before, "INFERIORITY", "was"))
    warns = F.col("inf") - F.col("was") > SHIFT
    text = F.when(F.col("n") == 0, "no matched store").when(warns, F.format_string("INFERIORITY %.1f%% -> %.1f%%", "was", "inf")).otherwise(F.format_string("SUP %.1f%% | PAR %.1f%% | INF %.1f%%", "sup", "par", "inf"))
    return one.where("n = 0 or m > 0").select(F.when((F.col("n") == 0) | warns, "WARNING").otherwise("INFO").alias("level"), F.lit("parity_distribution").alias("check"), F.lit("").alias("city_code"), text.alias("message"))


def freshness_report(rows: DataFrame, time: str, now) -> DataFrame:
    """The age in whole days of the newest row; none at all is an error, an old one warns."""
    one = rows.agg(F.max(time).alias("t")).withColumn("days", F.floor((F.unix_timestamp(now) - F.unix_timestamp("t")) / 86400))
    level = F.when(F.col("t").isNull(), "ERROR").when(F.col("days") > OLD_DAYS, "WARNING").otherwise("INFO")
    return one.select(level.alias("level"), F.lit("data_freshness").alias("check"), F.lit("").alias("city_code"), F.coalesce(F.format_string("%d days", "days"), F.lit("no data")).alias("message"))


def integrity_report(status: DataFrame, expected: DataFrame) -> DataFrame:
    """A table that was not written is an error, one with fewer rows than expected warns."""
    rows = status.join(expected, "name")
    level = F.when(F.col("rows") < 0, "ERROR").when(F.col("rows") < F.col("expected"), "WARNING").otherwise("INFO")
    return rows.select(level.alias("level"), F.lit("sheets_integrity").alias("check"), F.lit("").alias("city_code"), F.format_string("%s: %d of %d", "name", "rows", "expected").alias("message"))


def report(week: str, *checks: DataFrame) -> DataFrame:
    """All findings under their week; one row that nothing was found, if so."""
    found = checks[0]
    for c in checks[1:]:
        found = found.unionByName(c)
    none = found.agg(F.count("*").alias("k")).where("k = 0").select(F.lit("INFO").alias("level"), F.lit("all").alias("check"), F.lit("").alias("city_code"), F.lit("nothing found").alias("message"))
    return found.unionByName(none).withColumn("week_num", F.lit(week))


def summary(report_rows: DataFrame, actions: DataFrame, most: int = 5) -> DataFrame:
    """Counts by severity and the first actions as lines of text."""
    count = lambda v: F.count(F.when(F.col("level") == v, 1))
    head = report_rows.agg(F.format_string("errors %d, warnings %d, infos %d", count("ERROR"), count("WARNING"), count("INFO")).alias("line")).select(F.lit(0).alias("place"), "line")
    rows = actions.where(F.col("priority") <= most).select(F.col("priority").cast("int").alias("place"), F.format_string("%s %s: %.2f", "city_code", "store_name", "revenue").alias("line"))
    return head.unionByName(rows)
