"""The chunked table source, guarded sinks and the retention of raw files."""

import datetime as dt
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from promolens.operators import publish, retention
from promolens.sources import sheet, tables

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Flaky(sheet.SheetSource):
    """Stores a half of the first ``faults`` chunks that it is given."""

    @classmethod
    def name(cls):
        return "flaky"

    def store(self, path, data):
        for k in range(int(self.options.get("faults", 0))):
            try:
                os.close(os.open(f"{self.options['marks']}/{k}", os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                continue
            super().store(path, data[: len(data) // 2])
            return
        super().store(path, data)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_sheets_come_back(spark, tmp_path):
    sheet.register(spark)
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(k, f'x,"{k}"\nè', None) for k in range(100)], "a long, b string, c string").repartition(3)
    df.write.format("sheet").option("path", path).option("chunk", 7).mode("overwrite").save()
    back = spark.read.format("sheet").option("path", path).load()
    assert back.columns == ["a", "b", "c"] and rows(back) == sorted((str(k), f'x,"{k}"\nè', "") for k in range(100))
    assert back.rdd.getNumPartitions() == len(sheet.manifest(path)["chunks"]) >= 15
    df.limit(5).write.format("sheet").option("path", path).mode("append").save()
    assert spark.read.format("sheet").option("path", path).load().count() == 105
    with pytest.raises(Exception, match="do not continue"):
        df.select("b").write.format("sheet").option("path", path).mode("append").save()
    empty = spark.read.format("sheet").schema("a string").option("path", str(tmp_path / "none")).load()
    assert empty.count() == 0


def test_ragged_chunks(spark, tmp_path):
    sheet.register(spark)
    path = str(tmp_path / "t")
    sheet.write_bytes(f"{path}/c.csv", b"1\n2,3\n4,5,6\n")
    sheet.write_bytes(f"{path}/{sheet.MANIFEST}", b'{"columns": ["a", "b"], "chunks": [["c.csv", 3]]}')
    assert rows(spark.read.format("sheet").option("path", path).load()) == [("1", ""), ("2", "3"), ("4", "5")]


def test_failing_chunks_are_tried_again(spark, tmp_path):
    spark.dataSource.register(Flaky)
    df = spark.range(60).selectExpr("id as a").repartition(2)
    write = lambda name, faults, **more: (os.makedirs(tmp_path / f"{name}-marks", exist_ok=True), df.write.format("flaky").options(path=str(tmp_path / name), marks=str(tmp_path / f"{name}-marks"), faults=faults, chunk=10, wait=0, **more).mode("overwrite").save())
    write("once", 2)
    assert spark.read.format("flaky").option("path", str(tmp_path / "once")).load().count() == 60 and len(os.listdir(tmp_path / "once-marks")) == 2
    write("kept", 0)
    before = sheet.manifest(str(tmp_path / "kept"))
    with pytest.raises(Exception, match="rows arrived"):
        write("kept", 500, attempts=2)
    assert sheet.manifest(str(tmp_path / "kept")) == before  # the table is as it was
    assert spark.read.format("flaky").option("path", str(tmp_path / "kept")).load().count() == 60
    with pytest.raises(Exception, match="refusing to publish 60 rows"):
        write("kept", 0, least=100)
    assert sheet.manifest(str(tmp_path / "kept")) == before and len([d for d in os.listdir(tmp_path / "kept") if d.startswith("run-")]) == 1


def test_sinks_replace_what_arrived_whole(spark, tmp_path):
    path = str(tmp_path / "out")
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    week = lambda w, n: spark.range(n).selectExpr("id", f"'{w}' as week").mapInArrow(seen, "id long, week string")
    assert tables.write_verified(week("1", 5), path, 5, "week") == 5 and calls.value == 5  # made once
    assert tables.write_verified(week("2", 7), path, 5, "week") == 7
    assert tables.write_verified(week("1", 6), path, 5, "week") == 6
    assert {r["week"]: r["n"] for r in spark.read.parquet(path).groupBy("week").agg(F.count("*").alias("n")).collect()} == {1: 6, 2: 7}
    with pytest.raises(ValueError, match="refusing"):
        tables.write_verified(week("1", 3), path, 5, "week")
    assert spark.read.parquet(path).count() == 13 and os.listdir(tmp_path) == ["out"]


def test_repeated_headers_stay(spark, tmp_path):
    (tmp_path / "r.csv").write_text("﻿a,b,c\n1\na,b,c\n2,3,4\n")
    assert rows(tables.read_ragged(spark, str(tmp_path / "r.csv"), 3)) == [("1", "", ""), ("2", "3", "4"), ("a", "b", "c")]
    (tmp_path / "e.csv").write_text("a,b\n")
    with pytest.raises(ValueError):
        tables.read_ragged(spark, str(tmp_path / "e.csv"), 2)


def put(folder, *days):
    for d in days:
        os.makedirs(folder / f"ingest_date={d}", exist_ok=True)
        (folder / f"ingest_date={d}" / "part-0").write_bytes(b"no data that any reader could open")


def test_raw_files_over_weeks(spark, tmp_path):
    raw, old = tmp_path / "raw", tmp_path / "old"
    run = lambda day, weeks=2: retention.begin_run(spark, str(raw), str(old), dt.date.fromisoformat(day), weeks)
    have = lambda f: sorted(os.listdir(f)) if f.exists() else []
    assert run("2026-06-01") == "fresh"
    put(raw, "2026-06-01", "2026-06-02")
    assert run("2026-06-02") == "resume" and run("2026-06-04") == "resume"
    assert have(raw) == ["ingest_date=2026-06-01", "ingest_date=2026-06-02"]
    assert run("2026-06-05") == "reset" and have(raw) == []
    put(raw, "2026-06-05")
    assert run("2026-06-05") == "resume" and have(raw) == ["ingest_date=2026-06-05"]
    assert run("2026-06-08") == "archive" and have(raw) == [] and have(old / "2026-W23") == ["ingest_date=2026-06-05"]
    put(raw, "2026-06-05", "2026-06-08")  # a late file of an archived week replaces what is there
    assert run("2026-06-09") == "resume" and have(raw) == ["ingest_date=2026-06-08"] and have(old / "2026-W23") == ["ingest_date=2026-06-05"]
    put(raw, "2026-06-15")
    assert run("2026-12-28") == "archive" and have(old) == ["2026-W24", "2026-W25"]


def test_published_versions_go(spark, tmp_path):
    folder = str(tmp_path)
    for k in range(6):
        rows = spark.createDataFrame([("A", str(k), 1.0, k)], "city_code string, week_num string, w double, seq long")
        assert publish.publish(spark, {"city_parity": rows}, folder).first()["status"] == "ok"
    assert sorted(os.listdir(tmp_path / "city_parity")) == ["v=3", "v=4", "v=5"]
    assert publish.read_published(spark, folder, "city_parity").count() == 6
