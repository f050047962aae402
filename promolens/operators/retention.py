"""What raw files of a day are for: archived by week, dropped, or gone on with. Folders alone are looked at and moved, never data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

PARTITION = "ingest_date="
# Fixed value: the day on which a run starts afresh, as of Monday 0.
FRIDAY = 4
#: Archived weeks and published versions that stay.
WEEKS, VERSIONS = 8, 3


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    fs, place = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place) if s.getPath().getName().startswith(prefix)) if fs.exists(place) else []


def days(spark: SparkSession, folder: str) -> list[dt.date]:
    return [dt.date.fromisoformat(n.removeprefix(PARTITION)) for n in _names(spark, folder, PARTITION)]


def week_of(day: dt.date) -> str:
    year, week, _ = day.isocalendar()
    return f"{year}-W{week:02}"


def decide(newest: dt.date | None, today: dt.date) -> str:
    """What a run finds: ``fresh`` (nothing there), ``archive`` (another week), ``reset`` (Friday, but not of today), ``resume``."""
    if newest is None:
        return "fresh"
    if week_of(newest) != week_of(today):
        return "archive"
    return "reset" if today.weekday() == FRIDAY and newest != today else "resume"


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, place = _fs(spark, target)
    if fs.exists(place):
        fs.delete(place, True)
    fs.mkdirs(place.getParent())
    if not fs.rename(_fs(spark, source)[1], place):
        raise OSError(f"could not move {source} to {target}")


def begin_run(spark: SparkSession, folder: str, archive: str, today: dt.date, weeks: int = WEEKS) -> str:
    """Make a folder of ``ingest_date`` partitions ready for today's run; returns what was decided.

    Days of other weeks go to the archive under their week, whatever the newest is; a Friday drops
    what earlier days of its week have; the archive keeps its last ``weeks``. A run that stopped
    half way may begin again: what has moved stays moved.
    """
    found = days(spark, folder)
    decision = decide(max(found, default=None), today)
    for day in found:
        if week_of(day) != week_of(today):
            _move(spark, f"{folder}/{PARTITION}{day}", f"{archive}/{week_of(day)}/{PARTITION}{day}")
        elif decision == "reset":
            fs, place = _fs(spark, f"{folder}/{PARTITION}{day}")
            fs.delete(place, True)
    for name in _names(spark, archive, "")[:-weeks] if weeks else []:
        fs, place = _fs(spark, f"{archive}/{name}")
        fs.delete(place, True)
    return decision


def prune_versions(spark: SparkSession, marker: str, keep: int = VERSIONS) -> list[int]:
    """Drop a published table's versions but for the last ``keep`` whole ones; broken ones older than those go too."""
    numbers = sorted(int(n.removeprefix("v=")) for n in _names(spark, marker, "v="))
    whole = [n for n in numbers if (lambda fs, p: fs.exists(p))(*_fs(spark, f"{marker}/v={n}/_SUCCESS"))]
    if len(whole) < keep:
        return []
    gone = [n for n in numbers if n < whole[-keep]]
    for n in gone:
        fs, place = _fs(spark, f"{marker}/v={n}")
        fs.delete(place, True)
    return gone
