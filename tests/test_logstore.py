import threading

import pytest
from pyspark.sql import functions as F

from streamchain.operators import retention, seek
from streamchain.sources import datasource, logstore
from streamchain.streaming.sink import append as append_stream

SCHEMA = "stream_id string, seq long, height long, block_type int, shard_id long, bytes long"


def log_of(spark, streams=("s", None), seqs=range(1, 41), bytes_=10):
    rows = [(s, q, q * 3 if q % 11 else None, q % 2, q, bytes_ + q % 3) for s in streams for q in seqs]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture
def stored(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    logstore.append(log_of(spark, seqs=range(1, 25)), path, segment=8)
    logstore.append(log_of(spark, seqs=range(25, 41)), path, segment=8)
    return path


def read_rows(plan):
    """Rows that the scans of an executed plan have given."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return read_rows(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return read_rows(plan.plan())
    if name == "FileSourceScanExec":
        return plan.metrics().apply("numOutputRows").value()
    kids = plan.children()
    return sum(read_rows(kids.apply(i)) for i in range(kids.size()))


def test_read_what_was_appended(spark, stored):
    assert rows_of(logstore.read(spark, stored)) == rows_of(log_of(spark))
    assert rows_of(logstore.read(spark, stored, 1)) == rows_of(log_of(spark, seqs=range(1, 25)))
    assert logstore.version(spark, stored) == 2
    assert {(r.stream_id, r.last_seq) for r in logstore.heads(spark, stored).collect()} == {("s", 40), (None, 40)}


def test_rows_must_follow_their_heads(spark, stored):
    for seqs in (range(42, 44), range(40, 42), (41, 43)):
        with pytest.raises(logstore.Conflict):
            logstore.append(log_of(spark, seqs=seqs), stored)
    assert logstore.append(log_of(spark, seqs=()), stored) == 2  # nothing to add, no commit
    assert logstore.append(log_of(spark, ("new",), seqs=range(1, 3)), stored, at=1) == 3  # others' commits don't matter to a stream they don't touch
    with pytest.raises(logstore.Conflict):  # decided on an old version, and its streams have moved on
        logstore.append(log_of(spark, seqs=range(25, 27)), stored, at=1)
    assert logstore.read(spark, stored).count() == 82


def test_two_writers_at_once(spark, tmp_path):
    """Each writer adds what the output lacks of its own part of the log: every block is there once, whoever is faster."""
    path, blocks = f"file://{tmp_path}/out", log_of(spark, ("a", None), range(1, 61)).filter("height is not null").drop("seq")

    def work(low, high):
        def missing(output, at):
            rows = blocks.filter((F.col("height") > low) & (F.col("height") <= high))
            if output is not None:
                tips = output.groupBy("stream_id").agg(F.max("height").alias("tip"))
                rows = logstore.by_stream(rows, tips).filter("tip is null or height > tip").drop("tip")
            return logstore.following(rows, logstore.heads(spark, path, at), ["height"], F.expr("height div 16"))

        for step in range(3):
            logstore.written(spark, path, (lambda s: lambda o, at: missing(o, at).filter(F.col("height") <= high * (s + 1) / 3))(step))

    work_of = [threading.Thread(target=work, args=(0, high)) for high in (180, 120)]
    for t in work_of:
        t.start()
    for t in work_of:
        t.join()
    out = logstore.read(spark, path).collect()
    for stream in ("a", None):
        own = sorted((r.seq, r.height) for r in out if r.stream_id == stream)
        assert [q for q, _ in own] == list(range(1, len(own) + 1))
        assert [h for _, h in own] == [q * 3 for q in range(1, 61) if q % 11]


@pytest.mark.parametrize("height,start,end,greater", [(50, 0, 0, False), (33, 5, 0, True), (60, 20, 26, False), (500, 0, 0, False), (1, 60, 0, False)])
def test_seeks_read_two_segments_at_most(spark, stored, height, start, end, greater):
    found = logstore.seek_block(spark, stored, height, 1, 2, start, end, greater)
    assert rows_of(found) == rows_of(seek.seek_block(log_of(spark), height, 1, 2, start, end, greater))
    assert read_rows(found._jdf.queryExecution().executedPlan()) <= 2 * 2 * 8 + 2 * 12  # rows of segments, and of their table


def test_resume_from_the_tail(spark, tmp_path):
    path = f"file://{tmp_path}/copy"
    head = F.when((F.col("seq") % 5 == 0) & ((F.col("stream_id") == "s") | (F.col("seq") < 9)), F.create_map(F.lit("X-Source-Seq"), F.array((F.col("seq") * 2).cast("string"))))
    rows = log_of(spark, ("s", None, "none"), range(1, 81)).withColumn("headers", F.when(F.col("stream_id").isNull() | (F.col("stream_id") == "s"), head))
    logstore.append(rows, path, segment=4)
    assert {(r.stream_id, r.resume_seq) for r in logstore.resume_point(spark, path, "X-Source-Seq").collect()} == {("s", 160), (None, 10), ("none", 0)}


@pytest.mark.parametrize("most", [0, 95, 433, 10_000])
def test_shrinking_leaves_the_newest(spark, stored, most):
    want = rows_of(retention.newest_bytes(log_of(spark), most, F.col("bytes")))
    logstore.shrink(spark, stored, most)
    assert rows_of(logstore.read(spark, stored)) == want
    assert {r.last_seq for r in logstore.heads(spark, stored).collect()} == {40}
    logstore.purge(spark, stored)
    assert rows_of(logstore.read(spark, stored)) == want
    datasource.register(spark)
    assert rows_of(spark.read.format("streamlog").load(stored)) == want
    logstore.append(log_of(spark, seqs=range(41, 43), bytes_=1), stored, segment=8)
    assert logstore.read(spark, stored).count() == len(want) + 4


def test_data_source(spark, stored):
    datasource.register(spark)
    log = spark.read.format("streamlog").load(stored)
    assert log.schema == log_of(spark).schema
    assert rows_of(log) == rows_of(log_of(spark))
    some = log.filter("seq >= 7 and seq < 18 and height is not null")
    assert rows_of(some) == rows_of(log_of(spark).filter("seq >= 7 and seq < 18 and height is not null"))
    filters = [x for x in some._jdf.queryExecution().executedPlan().toString().splitlines() if x.strip(" +-*()1:").startswith("Filter")]
    assert filters and not any("= 7" in x or "< 18" in x for x in filters)  # those of seq are the source's own work
    reader = datasource.LogReader(stored, log.schema)
    left = list(reader.pushFilters([datasource.GreaterThanOrEqual(("seq",), 7), datasource.LessThan(("seq",), 18), datasource.EqualTo(("height",), 3)]))
    assert left == [datasource.EqualTo(("height",), 3)]
    assert {p.number for p in reader.partitions()} == {0, 1, 2} and len(reader.partitions()) == 6
    assert log.filter("seq = 999").count() == 0


def test_a_live_log_and_its_restart(spark, stored, tmp_path):
    datasource.register(spark)
    out = f"{tmp_path}/out"
    for seqs in ((), range(41, 50), ()):
        if seqs:
            logstore.append(log_of(spark, seqs=seqs), stored, segment=8)
        append_stream(spark.readStream.format("streamlog").load(stored), out, f"{tmp_path}/checkpoint").awaitTermination()
    assert rows_of(spark.read.parquet(out).drop("batch")) == rows_of(log_of(spark, seqs=range(1, 50)))
    late = spark.readStream.format("streamlog").option("startingCommit", 2).load(stored)
    append_stream(late, f"{out}2", f"{tmp_path}/checkpoint2").awaitTermination()
    assert rows_of(spark.read.parquet(f"{out}2").drop("batch")) == rows_of(log_of(spark, seqs=range(41, 50)))


def test_columns_made_of_others_are_stored_but_not_moved(spark, tmp_path):
    path, seen = f"file://{tmp_path}/log", []

    def adding(rows):
        seen.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows.withColumn("hash", F.md5(F.col("seq").cast("string").cast("binary"))).drop("shard_id")

    logstore.append(log_of(spark, seqs=range(1, 25)), path, segment=8, adding=adding)
    logstore.append(log_of(spark, seqs=range(25, 41)), path, segment=8, adding=adding)
    got = logstore.read(spark, path)
    assert got.columns == ["stream_id", "seq", "height", "block_type", "bytes", "hash"]
    assert rows_of(got) == rows_of(log_of(spark).withColumn("hash", F.md5(F.col("seq").cast("string").cast("binary"))).select(*got.columns))
    assert len(seen) == 2 and all("Exchange" in plan and "md5" not in plan for plan in seen)
    datasource.register(spark)
    assert rows_of(spark.read.format("streamlog").load(path)) == rows_of(got)


def test_many_segments_share_folders(spark, tmp_path):
    """Folders, and with them what listings send to the driver, grow by the logarithm of the number of segments; each segment is still read alone."""
    path, log = f"file://{tmp_path}/log", log_of(spark, ("s", None), range(1, 3001))
    logstore.append(log.filter("seq <= 1003"), path, segment=2)
    logstore.append(log.filter("seq > 1003"), path, segment=2)
    folders = [x for x in (tmp_path / "log/rows").glob("*/segment=*/stream=*")]
    assert len(folders) < 2 * 32 * 7  # of 1501 segments in two streams
    for n in range(3000):
        begin = n - n % datasource.width(n, 1 << 15)
        assert datasource.width(begin, 1 << 15) == datasource.width(n, 1 << 15) and begin <= n
    assert {f.parent.name for f in folders} == {f"segment={n - n % datasource.width(n, 1 << 15)}" for n in range(1501)}
    held = logstore.segments(spark, path)
    assert held.count() == 2 * 1501 and held.agg(F.max("msgs")).first()[0] == 2
    only = held.filter("segment in (0, 70, 501, 1499)")
    assert rows_of(logstore.read(spark, path, only=only)) == rows_of(log.filter("seq div 2 in (0, 70, 501, 1499)"))
    assert rows_of(logstore.seek_block(spark, path, 7000, start=5)) == rows_of(seek.seek_block(log, 7000, start=5))
    datasource.register(spark)
    source = lambda: spark.read.format("streamlog").load(path)
    assert rows_of(source().filter("seq >= 1001 and seq < 1010")) == rows_of(log.filter("seq >= 1001 and seq < 1010"))
    for most in (20_333, 5_001):
        want = rows_of(retention.newest_bytes(log, most, F.col("bytes")))
        logstore.shrink(spark, path, most)
        assert rows_of(logstore.read(spark, path)) == want == rows_of(source())
    gone = logstore.purge(spark, path)
    assert 0 < gone < len(folders) and rows_of(logstore.read(spark, path)) == want
    assert len(list((tmp_path / "log/rows").glob("*/segment=*/stream=*"))) == len(folders) - gone
