"""File tables: product scans, listings, managers, order values, weekly archives and guarded sinks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBERS = ("avg_unit_price", "avg_product_unit_price", "total_product_sold", "percentage_off_np", "percentage_off_p", "min_basket_size_np", "min_basket_size_p", "avg_percentage_off", "quantity_sold_np", "quantity_sold_p")
FLAGS = ("promo_non_prime", "promotion_prime", "has_active_promo")


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the schema in its order and types; missing ones are NULL."""
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place))


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, names trimmed, lower case and without blanks or a byte order mark.

    UTF-8, and Latin-1 where some text of the file is no UTF-8: the reader marks such bytes.
    """
    for encoding in ("UTF-8", "ISO-8859-1"):
        df = spark.read.csv(path, header=True, inferSchema=False, encoding=encoding, multiLine=True)
        names = [c.replace("\ufeff", "").strip().lower().replace(" ", "_") for c in df.columns]
        df = df.toDF(*names)
        broken = [F.coalesce(F.col(f"`{c}`").contains("\ufffd"), F.lit(False)) for c in names]
        if encoding != "UTF-8" or not any("\ufffd" in c for c in names) and df.where(reduce(lambda a, b: a | b, broken)).isEmpty():
            break
    return df


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table with the columns of the schema; none of its rows where there is no file."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return ensure_columns(read_text_table(spark, path), schema)


def read_ragged(spark: SparkSession, path: str, width: int) -> DataFrame:
    """Rows that are shorter than the header are eked out with blanks; a table without rows is an error.

    The first line alone is the header; a row that repeats it stays.
    """
    shape = ", ".join(f"c{k} string" for k in range(width))
    head = spark.read.csv(path, header=False, encoding="UTF-8", schema=shape).first()
    rows = spark.read.csv(path, header=True, enforceSchema=True, encoding="UTF-8", schema=shape)
    if rows.isEmpty():
        raise ValueError(f"no rows in {path}")
    names = [(head[k] or f"column_{k}").replace("\ufeff", "").strip() for k in range(width)]
    return rows.select(*[F.coalesce(f"c{k}", F.lit("")).alias(n) for k, n in enumerate(names)])


def managers(df: DataFrame) -> DataFrame:
    """Four columns of the managers' sheet, the first row of each store by its order in the sheet."""
    rows = df.where("trim(city_code) <> '' and trim(store_name) <> ''")
    first = rows.groupBy("city_code", "store_name").agg(F.min_by(F.struct("manager", "region"), "seq").alias("x"))
    return first.select("city_code", "store_name", "x.*")


def order_values(df: DataFrame, week: int) -> DataFrame:
    """The last value of each store in the current week; of all weeks where the current one has none at all."""
    rows = df.withColumn("aov", F.replace(F.col("aov"), F.lit(","), F.lit(".")).try_cast("double")).where("aov is not null")
    rows = rows.withColumn("now", F.coalesce(F.col("week_src").try_cast("int") == week, F.lit(False)))
    some = rows.agg(F.coalesce(F.max("now"), F.lit(False)).alias("some"))  # one row
    kept = rows.crossJoin(F.broadcast(some)).where("now or not some")
    return kept.groupBy("city_code", "store_name").agg(F.max_by("aov", "seq").alias("aov"))


def not_done(targets: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Targets that no earlier run has finished."""
    return targets.join(done.select(*key).distinct(), key, "left_anti")


def pick_and_rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Those of the columns that are there, under their new names."""
    return df.select(*[F.col(a).alias(b) for a, b in names.items() if a in df.columns])


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Either schema of the product file as one: names lower case, numbers 0 where they can't be read, flags trimmed upper case."""
    df = read_text_table(spark, path)
    if "promo_non_prime" not in df.columns:
        df = df.withColumnsRenamed({"has_active_promo": "promo_non_prime", "type_of_promo": "type_of_promo_np", "avg_percentage_off": "percentage_off_np"})
        df = df.withColumns({"promotion_prime": F.lit("N"), "type_of_promo_p": F.lit(""), "percentage_off_p": F.lit("0"), "min_basket_size_np": F.lit(None).cast("string")})
    if "avg_product_unit_price" in df.columns and "avg_unit_price" not in df.columns:
        df = df.withColumnRenamed("avg_product_unit_price", "avg_unit_price")
    fixed = {c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in NUMBERS if c in df.columns}
    fixed |= {c: F.upper(F.trim(F.coalesce(F.col(c), F.lit("N")))) for c in FLAGS if c in df.columns}
    fixed |= {c: F.upper(F.trim(F.coalesce(F.col(c), F.lit("")))) for c in ("type_of_promo_np", "type_of_promo_p") if c in df.columns}
    return df.withColumns(fixed)


def read_archives(spark: SparkSession, pattern: str) -> DataFrame:
    """Weekly files by pattern, the week taken from each file's name."""
    df = spark.read.option("header", True).csv(pattern)
    return df.withColumn("week_num", F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4}-W\d{2})", 1))


def import_seed(seed: DataFrame, mapping: DataFrame) -> DataFrame:
    """Seed pairs of stores that the mapping doesn't know yet, the first partner of each."""
    fresh = seed.where("trim(comp_name) <> ''").groupBy("city_code", "store_name").agg(F.min_by("comp_name", "seq").alias("comp_name"))
    return fresh.join(mapping, ["city_code", "store_name"], "left_anti").withColumn("source", F.lit("seed"))


def write_verified(df: DataFrame, path: str, least: int = 0, partition: str | None = None) -> int:
    """Refuse a table below ``least`` rows or one of which rows are lost on the way; returns their number.

    The table is made once, beside its place, counted as it is written and again as it is read; only
    then it, or each of its partitions, takes the place of what was there.
    """
    spark, seen, stage = df.sparkSession, Observation(), f"{path}.stage-{uuid.uuid4().hex}"
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write
    (writer.partitionBy(partition) if partition else writer).parquet(stage)
    n, back = seen.get["n"], spark.read.schema(df.schema).parquet(stage).count()
    jvm_path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        if n < least:
            raise ValueError(f"refusing to overwrite with {n} rows; {least} are expected at least")
        if back < n:
            raise RuntimeError(f"{back} of {n} rows arrived")
        found = [s.getPath().getName() for s in fs.listStatus(jvm_path(stage)) if s.isDirectory()] if partition else [""]
        for name in found:
            target = jvm_path(f"{path}/{name}".rstrip("/"))
            fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if not fs.rename(jvm_path(f"{stage}/{name}".rstrip("/")), target):
                raise OSError(f"could not move {name or stage} to {path}")
    finally:
        fs.delete(jvm_path(stage), True)
    return n
