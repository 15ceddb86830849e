"""Logs stored by segments of seqs, appended to by expected last seq, with a table of what each segment holds.

A store is a folder. Each append is a folder of Parquet rows below ``rows``, partitioned by
stream and by segment, or by several segments where a stream has many, so that listings stay
small, and one of what its segments hold below ``segments``; it is part of the log once a commit
names it. Commits are numbered from 0 on, and one is made only where none of its
number exists: of several writers one wins each number, and the others see what it added. This
needs a file system whose rename is atomic and doesn't replace a file, or a local one. The
driver handles commits alone; rows, heads and segments stay tables.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.headers import first_value
from ..functions.msgid import order_key
from ..operators import prefix
from ..operators.seek import outcome
from ..operators.sink import FEW_STREAMS, by_stream, on_keys
from .adapters import numbered
from .checkpoint import cut
from .datasource import FINE

#: Seqs of a segment; smaller segments share folders of as many seqs at most.
SEGMENT = 1 << 16
_PLACE = ["segment", "stream"]


class Conflict(Exception):
    """Rows don't follow the heads of their streams: another writer was there before, or they never did."""


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file with this content, if it isn't there; whether it was made."""
    at, system = _path(spark, path)
    own, _ = _path(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    system.mkdirs(own.getParent())
    out = system.create(own)
    out.write(bytearray(text.encode()))
    out.close()
    if system.getScheme() == "file":  # whose rename replaces
        source, to = own.toUri().getPath(), at.toUri().getPath()
        try:
            os.link(source, to)
        except FileExistsError:
            return False
        finally:
            system.delete(own, False)
        return True
    if system.rename(own, at):
        return True
    system.delete(own, False)
    return False


def commits(spark: SparkSession, path: str, upto: int | None = None) -> list[dict]:
    """The commits of a store, or its first ``upto``."""
    folder, system = _path(spark, f"{path}/commits")
    if not system.exists(folder):
        return []
    names = sorted(x.getPath().getName() for x in system.listStatus(folder))
    numbers = [int(n) for n in names if n.isdigit()][:upto]
    out = []
    for n in numbers:
        data = system.open(_path(spark, f"{path}/commits/{n:012d}")[0])
        out.append(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")))
        data.close()
    return out


def version(spark: SparkSession, path: str) -> int:
    return len(commits(spark, path))


def stream_key(stream: Column) -> Column:
    """The name of a stream's folders: never null, whatever characters its id has."""
    return F.hex(F.xxhash64(stream))


def _folder(segment: Column, most: int) -> Column:
    """The first segment of the folder that holds a segment: ``datasource.width`` of them lie in one."""
    width, one = F.lit(1), 2
    while one <= most:
        width = F.when(segment >= FINE * one, one).otherwise(width)
        one *= 2
    return (segment - segment % width).cast("long")


def _folders(path: str, kind: str, found: list[dict]) -> list[str]:
    return [f"{path}/{kind}/{c['batch']}" for c in found if c["kind"] == ("floors" if kind == "floors" else "rows")]


def _floors(spark: SparkSession, path: str, found: list[dict]) -> DataFrame | None:
    """stream_id, floor: the first seq that retention has left to a stream."""
    folders = _folders(path, "floors", found)
    if not folders:
        return None
    return spark.read.parquet(*folders).groupBy("stream_id").agg(F.max("floor").alias("floor"))


def read(spark: SparkSession, path: str, upto: int | None = None, only: DataFrame | None = None) -> DataFrame:
    """The rows of the log, as the first ``upto`` commits leave it; of those segments only, if given (segment, stream): the scan then reads folders that hold them alone."""
    found = commits(spark, path, upto)
    schema = T.StructType.fromJson(next(c["schema"] for c in found if c["kind"] == "rows"))
    placed = T.StructType([*schema.fields, T.StructField("segment", T.LongType()), T.StructField("stream", T.StringType())])
    made = [c for c in found if c["kind"] == "rows"]
    parts = [spark.read.schema(placed).option("basePath", folder).parquet(folder) for folder in _folders(path, "rows", made)]
    if only is not None:
        wanted = only.select(*_PLACE).distinct().filter(F.col("segment") > -(1 << 62))  # a comparison, without which Spark doesn't prune folders by a join
        few = only.limit(FEW_STREAMS + 1).count() <= FEW_STREAMS
        own = [wanted.withColumn("__own", F.col("segment")).withColumn("segment", _folder(F.col("segment"), c.get("folder", 1))) for c in made]
        own = [F.broadcast(w) if few else w for w in own]
        parts = [p.withColumn("__own", F.expr(f"seq div {c['segment']}")).join(w, [*_PLACE, "__own"], "left_semi") for p, w, c in zip(parts, own, made, strict=True)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    floors = _floors(spark, path, found)
    if floors is not None:
        rows = by_stream(rows, floors).filter("floor is null or seq >= floor")
    return rows.select(*schema.names)


def segments(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """What each segment of a stream holds: segment, stream, stream_id, first_seq, last_seq, least and greatest block, blockless rows, msgs, bytes."""
    found = commits(spark, path, upto)
    folders = _folders(path, "segments", found)
    held = spark.read.parquet(*folders).groupBy(*_PLACE, "stream_id").agg(
        F.min("first_seq").alias("first_seq"), F.max("last_seq").alias("last_seq"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.sum("blockless").alias("blockless"), F.sum("msgs").alias("msgs"), F.sum("bytes").alias("bytes"),
    )
    floors = _floors(spark, path, found)
    if floors is not None:
        held = by_stream(held, floors).filter("floor is null or last_seq >= floor").withColumn("first_seq", F.greatest("first_seq", "floor")).drop("floor")
    return held


def heads(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame | None:
    """stream_id, last_seq of every stream ever written to, whatever retention has left; None for an empty store."""
    folders = _folders(path, "segments", commits(spark, path, upto))
    return spark.read.parquet(*folders).groupBy("stream_id").agg(F.max("last_seq").alias("last_seq")) if folders else None


def _held(rows: DataFrame) -> DataFrame:
    named = [F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in (("height", "long"), ("block_type", "int"), ("shard_id", "long"))]
    size = F.col("bytes").cast("long") if "bytes" in rows.columns else F.lit(None).cast("long")
    key = F.when(F.col("height").isNotNull(), order_key(F.col("height"), F.col("block_type"), F.col("shard_id")))
    return rows.select(*_PLACE, "stream_id", "seq", *named, size.alias("bytes_")).groupBy(*_PLACE, "stream_id").agg(
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.min(key).alias("least"), F.max(key).alias("greatest"),
        F.count_if(F.col("height").isNull()).alias("blockless"), F.count("*").alias("msgs"), F.coalesce(F.sum("bytes_"), F.lit(0)).alias("bytes"),
    )


def append(rows: DataFrame, path: str, at: int | None = None, segment: int = SEGMENT, adding: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Add rows (stream_id, seq and more) that follow the heads of their streams, as commit ``at`` or later; the store's version then.

    In each stream the first seq is one above the last one written, and none is missing. Where
    another writer has taken the number, its rows are looked at: if streams of ours have moved
    on, nothing is written and Conflict is raised, and the caller verifies its rows again (see
    ``written``); else the next number is tried. No rows make no commit. ``adding`` gives the rows
    columns that are made of their others: they are stored too, but not moved to their segments.
    """
    spark = rows.sparkSession
    at = version(spark, path) if at is None else at
    batch = uuid.uuid4().hex
    own, folder = f"{path}/rows/{batch}", max(1, SEGMENT // segment)
    number = F.expr(f"seq div {segment}")
    placed = rows.withColumn("segment", _folder(number, folder)).withColumn("stream", stream_key(F.col("stream_id")))
    placed = placed.repartition(*_PLACE).sortWithinPartitions(*_PLACE, "seq")
    placed = adding(placed) if adding else placed
    placed.write.partitionBy(*_PLACE).parquet(own)
    schema = placed.drop(*_PLACE).schema
    names = T.StructType([*schema.fields, T.StructField("segment", T.LongType()), T.StructField("stream", T.StringType())])
    _held(spark.read.schema(names).parquet(own).withColumn("segment", number)).write.parquet(f"{path}/segments/{batch}")
    fresh = spark.read.parquet(f"{path}/segments/{batch}").groupBy("stream_id").agg(F.min("first_seq").alias("begin"), F.max("last_seq").alias("end"), F.sum("msgs").alias("msgs"))
    if fresh.isEmpty():
        _drop(spark, path, batch)
        return at
    commit = json.dumps({"kind": "rows", "batch": batch, "segment": segment, "folder": folder, "schema": schema.jsonValue()})
    while True:
        last = heads(spark, path, at)
        known = on_keys(fresh, last, ["stream_id"]) if last is not None else fresh.withColumn("last_seq", F.lit(None).cast("long"))
        wrong = known.filter((F.col("begin") != F.coalesce("last_seq", F.lit(0)) + 1) | (F.col("end") - F.col("begin") + 1 != F.col("msgs")))
        if wrong.count():
            some = [tuple(r) for r in wrong.select("stream_id", "begin", "last_seq").limit(3).collect()]
            _drop(spark, path, batch)
            raise Conflict(f"streams, first seqs and heads: {some}")
        if _create(spark, f"{path}/commits/{at:012d}", commit):
            return at + 1
        at += 1


def _drop(spark: SparkSession, path: str, batch: str) -> None:
    for kind in ("rows", "segments"):
        at, system = _path(spark, f"{path}/{kind}/{batch}")
        system.delete(at, True)


def written(spark: SparkSession, path: str, make: Callable[[DataFrame | None, int], DataFrame], segment: int = SEGMENT, tries: int = 100) -> int:
    """Append what ``make`` gives for the output so far (None while it is empty) and its version; where another writer was faster, ``make`` is asked again. The store's version then."""
    for _ in range(tries):
        at = version(spark, path)
        try:
            return append(make(read(spark, path, at) if at else None, at), path, at, segment)
        except Conflict:
            if version(spark, path) == at:
                raise  # nobody else wrote: the rows themselves don't follow
    raise Conflict(f"no commit after {tries} tries")


def following(rows: DataFrame, last: DataFrame | None, order: list[str], cell: Column) -> DataFrame:
    """The rows with the seqs that come next in their streams (last: stream_id, last_seq); ``cell``: a whole number that doesn't fall along the order."""
    out = numbered(rows, order, cell)
    if last is None:
        return out
    return by_stream(out, last).withColumn("seq", F.col("seq") + F.coalesce("last_seq", F.lit(0))).drop("last_seq")


def seek_block(spark: SparkSession, path: str, height: int, block_type: int = 0, shard_id: int = 0, start: int = 0, end: int = 0, only_greater: bool = False) -> DataFrame:
    """What ``operators.seek.seek_block`` gives, from at most two segments of each stream: the one that holds ``start``, and the first later one that reaches the target."""
    held = cut(segments(spark, path))
    target = order_key(F.lit(height).cast("long"), F.lit(block_type), F.lit(shard_id).cast("long"))
    past = (lambda key: key > target) if only_greater else (lambda key: key >= target)
    inside = F.col("last_seq") >= start
    if end:
        inside &= F.col("first_seq") < end
    able = held.filter(inside & ((F.col("blockless") > 0) | F.coalesce(past(F.col("greatest")), F.lit(False))))
    full = able.filter(F.col("first_seq") >= start).groupBy("stream").agg(F.min("segment").alias("segment"))
    wanted = cut(able.filter(F.col("first_seq") < start).select(*_PLACE).unionByName(full.select(*_PLACE)))
    key = order_key(F.col("height"), F.col("block_type"), F.col("shard_id"))
    hit = (F.col("seq") >= start) & (F.col("height").isNull() | past(key))
    if end:
        hit &= F.col("seq") < end
    hits = read(spark, path, only=wanted).filter(hit).groupBy("stream_id").agg(F.min("seq").alias("hit"))
    bounds = held.groupBy("stream_id").agg(F.min("first_seq").alias("first_seq"), F.max("last_seq").alias("last_seq"))
    return outcome(on_keys(bounds, hits, ["stream_id"]), start, end)


def resume_point(spark: SparkSession, path: str, state_header: str) -> DataFrame:
    """stream_id and the source seq that the newest row with such a header tells; 0 without any.

    In a copy, whose source seqs rise, that is the largest one. Segments are read from the
    newest on, in windows that double, for streams that have told nothing so far.
    """
    value = first_value(F.col("headers"), state_header)
    number = F.when(value.rlike("^[0-9]+$"), value.try_cast("decimal(20,0)"))
    newest = Window.partitionBy("stream").orderBy(F.desc("segment"))
    held = cut(segments(spark, path).withColumn("age", F.row_number().over(newest)))
    streams = held.select("stream_id", "stream").distinct()
    told, low, width = None, 0, 1
    while True:
        window = held.filter((F.col("age") > low) & (F.col("age") <= low + width))
        if told is not None:
            window = window.join(told, "stream", "left_anti")
        window = cut(window.select(*_PLACE))
        if window.isEmpty():
            break
        some = read(spark, path, only=window).select(stream_key(F.col("stream_id")).alias("stream"), "seq", number.alias("number")).filter("number is not null")
        some = cut(some.groupBy("stream").agg(F.max_by("number", "seq").cast("long").alias("resume_seq")))
        told = some if told is None else cut(told.unionByName(some))
        low, width = low + width, 2 * width
    told = told if told is not None else spark.createDataFrame([], "stream string, resume_seq long")
    return streams.join(told, "stream", "left").select("stream_id", F.coalesce("resume_seq", F.lit(0)).alias("resume_seq"))


def shrink(spark: SparkSession, path: str, most_bytes: int) -> int:
    """Leave each stream its newest rows that together hold at most so many bytes; the store's version then.

    The table of segments tells which are whole; rows of the one at the edge alone are read.
    What is left begins at a seq, which a commit records; first and last seqs stay known.
    ``purge`` then removes the files of segments below it.
    """
    at = version(spark, path)
    newer = Window.partitionBy("stream").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)
    held = cut(segments(spark, path, at).withColumn("newer_segments", F.coalesce(F.sum("bytes").over(newer), F.lit(0))))
    edge = held.filter((F.col("newer_segments") <= most_bytes) & (F.col("newer_segments") + F.col("bytes") > most_bytes))
    edge = cut(edge.select(*_PLACE, "stream_id", "newer_segments"))
    rows = read(spark, path, at, only=edge).select("stream_id", "seq", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    rows = prefix.before(rows, {"newer": ("sum", F.col("bytes"))}, descending=True)
    kept = on_keys(rows, edge.select("stream_id", "newer_segments"), ["stream_id"]).filter(F.col("newer_segments") + F.col("newer") + F.col("bytes") <= most_bytes)
    kept = kept.groupBy("stream_id").agg(F.min("seq").alias("floor"))
    # a stream whose edge keeps no row begins at the segment after it, or is empty
    later = on_keys(held, edge.select("stream_id", F.col("segment").alias("edge")), ["stream_id"]).filter("edge is not null")
    later = later.groupBy("stream_id").agg(F.min(F.when(F.col("segment") > F.col("edge"), F.col("first_seq"))).alias("next"), (F.max("last_seq") + 1).alias("none"))
    floors = on_keys(later, kept, ["stream_id"]).select("stream_id", stream_key(F.col("stream_id")).alias("stream"), F.coalesce("floor", "next", "none").alias("floor"))
    batch = uuid.uuid4().hex
    floors.write.parquet(f"{path}/floors/{batch}")
    while not _create(spark, f"{path}/commits/{at:012d}", json.dumps({"kind": "floors", "batch": batch})):
        at += 1  # floors only rise, whatever others append
    return at + 1


def purge(spark: SparkSession, path: str) -> int:
    """Remove folders that lie below their stream's floor as a whole; how many. Readers of earlier versions lose them."""
    found = commits(spark, path)
    floors = _floors(spark, path, found)
    if floors is None:
        return 0
    gone = 0
    for c in found:
        if c["kind"] == "rows":
            held = spark.read.parquet(f"{path}/segments/{c['batch']}").withColumn("segment", _folder(F.col("segment"), c.get("folder", 1)))
            held = held.groupBy(*_PLACE, "stream_id").agg(F.max("last_seq").alias("last_seq"))
            for r in by_stream(held, floors).filter("last_seq < floor").select(*_PLACE).toLocalIterator():
                at, system = _path(spark, f"{path}/rows/{c['batch']}/segment={r['segment']}/stream={r['stream']}")
                gone += bool(system.delete(at, True))
    return gone
