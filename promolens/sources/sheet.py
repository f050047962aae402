"""A table of text chunks as a data source of its own (S06, S08, K06): written in chunks with retries, seen when whole.

Rows go out as CSV chunks of bounded size, each read back and counted; a chunk that fails is tried
again. A table is what its manifest names, and the manifest is replaced last, after the counts of
all tasks agree, so a write that fails leaves the table as it was. The folder must be one that the
driver and all executors share.
"""

from __future__ import annotations

import csv
import io
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StringType, StructField, StructType

# Rows of a chunk, attempts, and seconds that the wait grows by with each.
CHUNK, ATTEMPTS, WAIT = 25_000, 3, 5.0
MANIFEST = "_manifest.json"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def read_bytes(path: str) -> bytes | None:
    system, where = _place(path)
    if system.get_file_info(where).type == fs.FileType.NotFound:
        return None
    with system.open_input_stream(where) as f:
        return f.read()


def write_bytes(path: str, data: bytes) -> None:
    system, where = _place(path)
    system.create_dir(where.rpartition("/")[0])
    with system.open_output_stream(where) as f:
        f.write(data)


def manifest(path: str) -> dict:
    """Names and files of a table; a table that was never written has neither."""
    found = read_bytes(f"{path}/{MANIFEST}")
    return json.loads(found) if found else {"columns": [], "chunks": []}


def parse(data: bytes) -> list[list[str]]:
    return list(csv.reader(io.StringIO(data.decode("utf-8-sig"), newline="")))


@dataclass
class Written(WriterCommitMessage):
    chunks: list[tuple[str, int]]


@dataclass
class Chunk(InputPartition):
    path: str


class SheetReader(DataSourceReader):
    """A partition for each chunk; rows that are shorter than the header are eked out with blanks, longer ones cut."""

    def __init__(self, path: str, width: int, chunks: list) -> None:
        self.path, self.width, self.chunks = path, width, chunks

    def partitions(self) -> list[Chunk]:
        return [Chunk(f"{self.path}/{name}") for name, _ in self.chunks] or [Chunk("")]  # Spark asks for one at least

    def read(self, partition: Chunk) -> Iterator[tuple]:
        data = read_bytes(partition.path) if partition.path else b""
        if data is None:
            raise FileNotFoundError(partition.path)
        for row in parse(data):
            yield tuple((row + [""] * self.width)[: self.width])


class SheetWriter(DataSourceWriter):
    def __init__(self, source: SheetSource, schema: StructType, overwrite: bool) -> None:
        self.source, self.columns, self.overwrite = source, schema.names, overwrite
        option = source.options.get
        self.path, self.run = option("path"), uuid.uuid4().hex
        self.chunk, self.attempts, self.wait = int(option("chunk", CHUNK)), int(option("attempts", ATTEMPTS)), float(option("wait", WAIT))
        self.least, self.header = int(option("least", 0)), option("expected")

    def write(self, iterator: Iterator[Row]) -> Written:
        done, rows, mine = [], [], uuid.uuid4().hex
        for row in iterator:
            rows.append(["" if v is None else str(v) for v in row])
            if len(rows) == self.chunk:
                done.append(self._put(f"run-{self.run}/{mine}-{len(done):06}.csv", rows))
                rows = []
        if rows:
            done.append(self._put(f"run-{self.run}/{mine}-{len(done):06}.csv", rows))
        return Written(done)

    def _put(self, name: str, rows: list[list[str]]) -> tuple[str, int]:
        """One chunk, read back and counted, tried again with longer and longer waits."""
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator="\n").writerows(rows)
        for attempt in range(1, self.attempts + 1):
            try:
                self.source.store(f"{self.path}/{name}", out.getvalue().encode())
                back = len(parse(read_bytes(f"{self.path}/{name}") or b""))
                if back != len(rows):
                    raise OSError(f"{back} of {len(rows)} rows arrived in {name}")
                return name, len(rows)
            except OSError:
                if attempt == self.attempts:
                    raise
                time.sleep(self.wait * attempt)
        raise AssertionError("unreachable")

    def commit(self, messages: list[Written | None]) -> None:
        chunks = [c for m in messages if m for c in m.chunks]
        n = sum(k for _, k in chunks)
        if any(m is None for m in messages) or n < self.least or (self.header is not None and n < int(self.header)):
            self.abort(messages)
            raise ValueError(f"refusing to publish {n} rows; {max(self.least, int(self.header or 0))} are expected at least")
        before = manifest(self.path)
        if not self.overwrite and before["chunks"]:
            if before["columns"] != self.columns:
                raise ValueError(f"columns {self.columns} do not continue {before['columns']}")
            chunks = before["chunks"] + chunks
        write_bytes(f"{self.path}/{MANIFEST}", json.dumps({"columns": self.columns, "chunks": chunks}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, where = _place(f"{self.path}/run-{self.run}")
        if system.get_file_info(where).type != fs.FileType.NotFound:
            system.delete_dir(where)


class SheetSource(DataSource):
    """Options: path; to write also chunk, attempts, wait (seconds), least and expected (rows)."""

    @classmethod
    def name(cls) -> str:
        return "sheet"

    def schema(self) -> StructType:
        columns = manifest(self.options["path"])["columns"]
        if not columns:
            raise ValueError(f"no table at {self.options['path']}; give a schema to read it as empty")
        return StructType([StructField(c, StringType()) for c in columns])

    def reader(self, schema: StructType) -> SheetReader:
        """A given schema of text columns stands for a missing table; else the table's own columns."""
        path = self.options["path"]
        found = manifest(path)
        if found["columns"] and list(schema.names) != found["columns"]:
            raise ValueError(f"the table has columns {found['columns']}")
        return SheetReader(path, len(schema.names), found["chunks"])

    def writer(self, schema: StructType, overwrite: bool) -> SheetWriter:
        return SheetWriter(self, schema, overwrite)

    def store(self, path: str, data: bytes) -> None:
        write_bytes(path, data)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SheetSource)
