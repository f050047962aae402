"""Logical tables by name, each from the first of its sources that is there, read when asked for and not before."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from promolens.operators import commands, publish, state
from promolens.plans.bridge import load
from promolens.sources import tables


@dataclass(frozen=True)
class Source:
    """Where a table may come from: whether it is there, by metadata alone, and how it is read."""

    there: Callable[[Registry], bool]
    read: Callable[[Registry], DataFrame]


def published(folder: str, name: str) -> Source:
    """The last whole version that publish has written."""
    return Source(lambda r: publish.latest_version(r.spark, f"{folder}/{name}") >= 0, lambda r: publish.read_published(r.spark, folder, name))


def archived(pattern: str) -> Source:
    """Weekly files, the week taken from their names."""
    return Source(lambda r: tables.exists(r.spark, pattern), lambda r: tables.read_archives(r.spark, pattern))


def parquet(path: str) -> Source:
    return Source(lambda r: tables.exists(r.spark, path), lambda r: r.spark.read.parquet(path))


def made(read: Callable[[Registry], DataFrame]) -> Source:
    """Worked out from other tables."""
    return Source(lambda r: True, read)


class Registry:
    """Tables by name. ``registry(name)`` plans a table; nothing else is read, listed or planned for it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._entries: dict[str, tuple[tuple[Source, ...], StructType | None, Callable[[Registry, DataFrame], DataFrame] | None]] = {}
        self._planned: dict[str, DataFrame] = {}

    def add(self, name: str, *sources: Source, schema: StructType | str | None = None, overlay: Callable[[Registry, DataFrame], DataFrame] | None = None) -> Registry:
        """Sources in order of preference. With a schema all come with its columns and types (what can't
        be read as such is NULL) and a table that no source has is empty; an overlay has the last word."""
        shape = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self._entries[name] = (sources, shape, overlay)
        self._planned.pop(name, None)
        return self

    def __call__(self, name: str) -> DataFrame:
        if name not in self._planned:
            if name not in self._entries:
                raise KeyError(f"no table {name}; there are {', '.join(sorted(self._entries))}")
            sources, shape, overlay = self._entries[name]
            found = next((s for s in sources if s.there(self)), None)
            if found is None and shape is None:
                raise FileNotFoundError(f"no source of {name} is there")
            df = self.spark.createDataFrame([], shape) if found is None else found.read(self)
            df = tables.ensure_columns(df, shape) if shape is not None else df
            self._planned[name] = overlay(self, df) if overlay else df
        return self._planned[name]

    def forget(self, *names: str) -> None:
        """After a change these (or all) tables are looked for anew."""
        for name in names or list(self._planned):
            self._planned.pop(name, None)


def decided(log: str, key: tuple[str, str] = ("city_code", "store_name")) -> Callable[[Registry, DataFrame], DataFrame]:
    """A mapping with a log of decisions replayed over it."""
    return lambda r, mapping: state.merge_log(mapping, state.fold_log(r(log), list(key)))


def unsettled(log: str) -> Callable[[Registry, DataFrame], DataFrame]:
    """A review queue without the stores that a log of decisions settles."""
    return lambda r, review: review.join(r(log).select("city_code", "store_name").distinct(), ["city_code", "store_name"], "left_anti")


def commanded(base: str, folder: str) -> Callable[[Registry, DataFrame], DataFrame]:
    """A mapping with the commands of a folder's log applied."""
    return lambda r, mapping: commands.apply(mapping, r(base), commands.log(r.spark, folder))[0]


class Tables(Registry):
    """The driver's tables and the bridge's views; names are told apart when they are asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__(spark)
        self.sf_dir = sf_dir

    def __call__(self, name: str) -> DataFrame:
        if name not in self._entries:
            self.add(name, made(lambda r: load(r.spark, self.sf_dir, name)))
        return super().__call__(name)
