"""Stored logs as a data source of Spark's own interface: ``spark.read.format("streamlog")`` and ``spark.readStream.format("streamlog")``."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual


#: Segments of a stream below twice this number have a folder each.
FINE = 32


def width(segment: int, most: int) -> int:
    """How many segments share the folder that begins with this one: from the 64th on two, from the 128th on four, and so on, ``most`` at most, so that a log of n segments has some 32 log2(n) folders, or one for ``most``."""
    out = 1
    while 2 * out <= most and segment >= 2 * FINE * out:
        out *= 2
    return out


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def commits(path: str) -> list[dict]:
    """The store's commits in order; those still being made aren't listed."""
    system, root = _open(path)
    found = system.get_file_info(pafs.FileSelector(f"{root}/commits", allow_not_found=True))
    names = sorted(x.path for x in found if x.base_name.isdigit())
    out = []
    for name in names:
        with system.open_input_stream(name) as data:
            out.append(json.loads(data.read()))
    return out


@dataclass
class Segment(InputPartition):
    """Files of one folder of one stream in one commit, with the segment that it begins with; ``floor``: the first seq that retention has left."""

    files: list[str]
    number: int = 0
    floor: int | None = None
    bounds: list[tuple[str, int]] = field(default_factory=list)


def _segments(path: str, batches: list[dict]) -> Iterator[tuple[dict, str, Segment]]:
    """(commit, stream folder, segment) of these commits."""
    system, root = _open(path)
    for c in batches:
        held: dict[tuple[str, str], list[str]] = {}
        for x in system.get_file_info(pafs.FileSelector(f"{root}/rows/{c['batch']}", recursive=True, allow_not_found=True)):
            if x.is_file and x.base_name.endswith(".parquet"):
                segment, stream = posixpath.dirname(x.path).split("/")[-2:]
                held.setdefault((segment.removeprefix("segment="), stream.removeprefix("stream=")), []).append(x.path)
        for (segment, stream), files in sorted(held.items()):
            yield c, stream, Segment(sorted(files), int(segment))


def _read(path: str, schema: T.StructType, part: Segment) -> Iterator[pa.RecordBatch]:
    system, _ = _open(path)
    where = None
    tests = [*part.bounds, *([(">=", part.floor)] if part.floor is not None else [])]
    for sign, value in tests:
        seq = ds.field("seq")
        one = {">=": seq >= value, ">": seq > value, "<=": seq <= value, "<": seq < value, "=": seq == value}[sign]
        where = one if where is None else where & one
    for batch in ds.dataset(part.files, filesystem=system, format="parquet").to_batches(columns=schema.names, filter=where):
        if batch.num_rows:
            yield batch


class LogSource(DataSource):
    """A log that ``logstore.append`` wrote. Option ``path`` (or load's argument): the store, on a file system that Arrow opens.

    A batch read makes a partition of each folder of segments and takes over comparisons of seq, by which
    whole segments and row groups are skipped; rows below a stream's retained tail are left
    out. A stream starts with commit ``startingCommit`` (0 if not given); its offset is the
    number of commits, of which each adds the next seqs of its streams in one step, so that an
    offset stays as small however many streams there are. A restarted query goes on from its
    checkpoint; retention isn't applied to what a stream reads, since it has read it or would
    miss it.
    """

    @classmethod
    def name(cls) -> str:
        return "streamlog"

    def schema(self) -> T.StructType:
        first = next((c for c in commits(self.options["path"]) if c["kind"] == "rows"), None)
        if first is None:
            raise ValueError(f"nothing has been written to {self.options['path']}: give a schema")
        return T.StructType.fromJson(first["schema"])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return LogReader(self.options["path"], schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return LogStreamReader(self.options["path"], schema, int(self.options.get("startingCommit", 0)))


class LogReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.columns = path, schema
        self.bounds: list[tuple[str, int]] = []

    def pushFilters(self, filters: list) -> Iterator:
        signs = {GreaterThanOrEqual: ">=", GreaterThan: ">", LessThanOrEqual: "<=", LessThan: "<", EqualTo: "="}
        for one in filters:
            if type(one) in signs and one.attribute == ("seq",) and isinstance(one.value, int):
                self.bounds.append((signs[type(one)], one.value))
            else:
                yield one

    def partitions(self) -> Sequence[Segment]:
        found = commits(self.path)
        floors: dict[str, int] = {}
        system, root = _open(self.path)
        for c in found:
            if c["kind"] == "floors":
                held = ds.dataset(f"{root}/floors/{c['batch']}", filesystem=system, format="parquet").to_table(columns=["stream", "floor"])
                for stream, floor in zip(held["stream"].to_pylist(), held["floor"].to_pylist(), strict=True):
                    floors[stream] = max(floor, floors.get(stream, floor))
        out = []
        for c, stream, part in _segments(self.path, [c for c in found if c["kind"] == "rows"]):
            low, high = part.number * c["segment"], (part.number + width(part.number, c.get("folder", 1))) * c["segment"] - 1
            part.floor, part.bounds = floors.get(stream), self.bounds
            wanted = all({">=": high >= v, ">": high > v, "<=": low <= v, "<": low < v, "=": low <= v <= high}[sign] for sign, v in self.bounds)
            if wanted and (part.floor is None or high >= part.floor):
                out.append(part)
        return out or [Segment([])]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return _read(self.path, self.columns, partition) if partition.files else iter(())


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, path: str, schema: T.StructType, begin: int):
        self.path, self.columns, self.begin = path, schema, begin

    def initialOffset(self) -> dict:
        return {"commits": self.begin}

    def latestOffset(self) -> dict:
        return {"commits": max(self.begin, len(commits(self.path)))}

    def partitions(self, start: dict, end: dict) -> Sequence[Segment]:
        found = commits(self.path)[start["commits"] : end["commits"]]
        return [part for _, _, part in _segments(self.path, [c for c in found if c["kind"] == "rows"])]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return _read(self.path, self.columns, partition)


def register(spark: SparkSession) -> None:
    """Let this session read the format; its filters are pushed down from then on."""
    spark.dataSource.register(LogSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
