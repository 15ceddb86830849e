"""Logs derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.msgid import construct
from ..operators import prefix
from ..operators.merge import placed
from ..operators.sink import FEW_STREAMS
from ..schema import MESSAGE_ID
from . import files
from .checkpoint import cut, exists, own_folder
from .decode import encode

STREAMS = 8
#: Heights of a cell, whose rows are ranked together.
CELL = 1 << 17
#: Days of a cell.
DAYS = 16
#: Rows that a task ranks and writes, about.
PLACED = 1 << 20
_LOG = ("stream_id", "seq", "height", "block_type", "shard_id", "hash", "prev_hash", "ts")
#: What is stored of them: hashes are made of heights where they are asked for.
_HELD = ("stream_id", "seq", "height", "block_type", "shard_id", "before", "ts")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as announcements and their lines as shards, with the order before in their stream and the columns that order rows of one place."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    tasks = -(-lines.count() // PLACED)
    heads = orders.select("o_orderkey", (F.col("o_custkey") % STREAMS).alias("stream_id"), "o_orderdate")
    heads = prefix.previous(heads, {"before": "o_orderkey"}, order="o_orderkey")
    zero = [F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(0.0).alias("k3")]
    common = ["stream_id", F.col("o_orderkey").alias("height"), "before"]
    announced = heads.select(*common, F.lit(0).alias("block_type"), F.lit(0).cast("long").alias("shard_id"), F.col("o_orderdate").alias("ts"), *zero)
    ordered = heads
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):  # a task of the join sorts so many lines at most, however many there are
        lines, ordered = lines.repartition(tasks, "l_orderkey"), heads.repartition(tasks, "o_orderkey")
    shards = lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *common, F.lit(1).alias("block_type"), F.col("l_linenumber").cast("long").alias("shard_id"), F.col("l_shipdate").alias("ts"),
        F.col("l_partkey").cast("long").alias("k1"), F.col("l_suppkey").cast("long").alias("k2"), F.col("l_extendedprice").alias("k3"),
    )
    return announced.unionByName(shards)


def numbered(rows: DataFrame, order: list[str], cell: Column) -> DataFrame:
    """The rows with seq: their place in their stream by ``order``, from 1 on.

    ``cell``: a whole number that doesn't fall along the order. Rows are counted by cell, the
    counts are summed up over cells, and only within a cell are rows ranked: no window holds a
    stream. Rows move once, by cell (a struct, in which nulls are equal), to as many tasks as
    their number asks for; where cells begin is broadcast if they are few.
    """
    rows = rows.withColumn("__cell", F.struct("stream_id", cell.alias("n")))
    counts = rows.groupBy("__cell").count().select("__cell.stream_id", F.col("__cell.n").alias("n"), "count")
    begins = cut(prefix.before(counts, {"begin": ("sum", F.col("count"))}, order="n").select(F.struct("stream_id", "n").alias("of_cell"), "begin", "count"))
    many, total = begins.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // PLACED))
    begins = begins.drop("count")
    rank = F.row_number().over(Window.partitionBy("__cell").orderBy(*order))
    ranked = rows.repartition(tasks, "__cell").withColumn("rank", rank)
    ranked = ranked.join(F.broadcast(begins) if many <= FEW_STREAMS else begins, F.col("__cell") == F.col("of_cell"))
    return ranked.withColumn("seq", F.coalesce("begin", F.lit(0)).cast("long") + F.col("rank")).drop("__cell", "of_cell", "begin", "rank")


_STORED: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    """The log that ``make`` gives, written once a session below the shared folder, by stream, and scanned from there.

    Its tasks should hold ranges of seqs, as those of ``numbered`` and of scans of such logs do: rows don't move to be written.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED or not exists(spark, f"{_STORED[key][0]}/_SUCCESS"):
        log, path = make(spark, sf_dir), f"{own_folder(spark, 'logs')}/{name}"
        files.write(log, path, placed=True)
        _STORED[key] = path, log.schema
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _chain_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["height", "block_type", "ts", "shard_id", "k1", "k2", "k3"]
    return numbered(_rows(spark, sf_dir), order, F.expr(f"height div {CELL}")).select(*_HELD)


def hashed(log: DataFrame) -> DataFrame:
    """A stored log with its hashes: what moves rows about may do so before."""
    digest = lambda c: F.md5(F.col(c).cast("string").cast("binary"))
    rows = log.withColumn("hash", digest("height")).withColumn("prev_hash", F.coalesce(digest("before"), F.lit("")))
    return rows.select(*_LOG, *[c for c in log.columns if c not in _HELD])


def chain_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain log without its hashes."""
    return stored(spark, sf_dir, "chain_log", _chain_log)


def chain_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks in their own order: nearly a valid chain."""
    return hashed(chain_held(spark, sf_dir))


def _noisy_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["ts", "height", "block_type", "shard_id", "k1", "k2", "k3"]
    return numbered(_rows(spark, sf_dir), order, F.expr(f"datediff(cast(ts as date), date '1970-01-01') div {DAYS}")).select(*_HELD)


def noisy_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows in the order of their times: far from a chain."""
    return hashed(stored(spark, sf_dir, "noisy_log", _noisy_log))


def payload_log(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The blocks of the chain log as messages with payloads of a format, a hundredth of them broken; most have a message id."""

    def make(spark: SparkSession, sf_dir: str) -> DataFrame:
        blocks = chain_log(spark, sf_dir).drop("ts")
        sent = encode(blocks if kind == "proto_zstd" else blocks.filter("block_type = 0"), kind, without=("hash", "prev_hash"))
        data = F.when(F.col("seq") % 100 == 0, F.lit(b"\x07x")).otherwise(F.col("data")).alias("data")
        id_ = construct(F.col("height"), F.col("block_type"), F.col("shard_id"))
        held = F.when(F.col("seq") % 5 != 0, F.create_map(F.lit(MESSAGE_ID), F.array(id_))).otherwise(F.create_map().cast("map<string,array<string>>"))
        return sent.select("stream_id", "seq", F.concat(F.lit("blk."), F.col("seq") % 3).alias("subject"), held.alias("headers"), data)

    return stored(spark, sf_dir, f"payloads_{kind}", make)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream a user; heights jump about, and errors count as corrupted rows."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("stream_id"), F.col("event_id").alias("seq"), F.regexp_extract("props", "([0-9]+)", 1).cast("long").alias("height"),
        (F.col("event_type") == "error").alias("corrupted"), F.col("event_type").alias("subject"), "value", F.length("props").cast("long").alias("bytes"), "ts",
    )


def conv_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as blocks: the first turn announces, others are shards; one stream."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.lit(0).alias("stream_id"), F.col("conv_id").alias("height"), F.when(F.col("turn") == 0, 0).otherwise(1).alias("block_type"), F.col("turn").alias("shard_id"),
        F.octet_length("text").cast("long").alias("bytes"),
    )


def doc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as messages of one stream with subjects ``lang.source``; the texts are not read."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.lit("docs").alias("stream_id"), (F.col("doc_id") + 1).alias("seq"), F.concat_ws(".", "lang", "source").alias("subject"), F.col("n_chars").alias("bytes"))


def shard_masks(log: DataFrame) -> DataFrame:
    """stream_id, height and the mask of the shards that the log has for it."""
    ids = log.filter("block_type = 1").groupBy("stream_id", "height").agg(F.collect_set("shard_id").alias("ids"))
    mask = F.transform(F.sequence(F.lit(0).cast("long"), F.array_max("ids")), lambda i: F.array_contains("ids", i))
    return ids.select("stream_id", "height", mask.alias("shard_mask"))


def inputs(log: DataFrame) -> DataFrame:
    """Two redundant inputs with holes, of the blocks of a log: "a" lacks heights divisible by 3, "b" those divisible by 5."""
    log = log.filter("block_type = 0")
    a = log.filter("height % 3 <> 0").withColumn("input_id", F.lit("a"))
    return a.unionByName(log.filter("height % 5 <> 0").withColumn("input_id", F.lit("b")))


def redundant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inputs that together have every block: "a" lacks a third of the heights and has others whose link is broken, "b" lacks another third.

    Blocks are dealt by heights, as merges need them, before they have hashes and are doubled.
    """
    log = hashed(placed(chain_held(spark, sf_dir).filter("block_type = 0")))
    both = F.array_compact(F.array(F.when(F.col("height") % 3 != 0, "a"), F.when(F.col("height") % 3 != 1, "b")))
    broken = (F.col("input_id") == "a") & (F.col("height") % 7 == 0) & (F.col("height") % 3 == 2)
    return log.withColumn("input_id", F.explode(both)).withColumn("prev_hash", F.when(broken, "bad").otherwise(F.col("prev_hash")))
