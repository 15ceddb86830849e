import random
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from streamchain.operators import chain, merge, metrics
from streamchain.operators.chain import Bridge
from streamchain.operators.tolerance import Tolerances
from streamchain.operators.verify import Verifier
from streamchain.streaming import chain as live
from streamchain.streaming import merge as live_merge
from streamchain.streaming import silence
from streamchain.streaming.sink import append, stop_between

from .test_chains import SCHEMA, random_log


def test_a_live_log_gives_what_its_table_gives(spark, tmp_path):
    rows = [r if r[1] % 9 else (r[0], r[1], *(None,) * 6, True) for r in random_log(5, n=60, streams=3)]
    log = spark.createDataFrame(rows, SCHEMA)
    for k in range(3):  # the log grows by twenty seqs a file
        log.filter((F.col("seq") > 20 * k) & (F.col("seq") <= 20 * k + 20)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    config = Bridge(Verifier(allow_gaps=False), buffer=4, tolerances=Tolerances(no_write=25))
    source = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second run has nothing left to do
        append(live.follow(source, config), f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    got = sorted(map(str, (tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").drop("batch").collect())))
    want = sorted(map(str, (tuple(r) for r in chain.fold(log, config).collect())))
    assert got == want and len(want) > 3


def test_repeated_ids_within_a_window(spark, tmp_path):
    rows = spark.sql("select * from values ('s', '1', timestamp '2024-01-01 00:00:00'), ('s', '1', timestamp '2024-01-01 00:00:30'), ('s', '2', timestamp '2024-01-01 00:00:31') as t(stream_id, msg_id, ts)")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    append(live.deduplicated(source), f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    assert sorted(r.msg_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["1", "2"]


def waits(query, path, rows, spark, seconds=60):
    """The rows of an output folder, once there are so many."""
    until = time.monotonic() + seconds
    while True:
        assert query.exception() is None
        try:
            found = spark.read.parquet(path).drop("batch").collect()
        except AnalysisException:
            found = []
        if len(found) >= rows or time.monotonic() > until:
            return found
        time.sleep(0.5)


def test_the_output_of_another_writer_lets_held_rows_out_by_a_timer(spark, tmp_path):
    shape = "stream_id string, seq long, height long, block_type int, shard_id long"
    source = lambda name: spark.readStream.schema(shape).parquet(f"{tmp_path}/{name}")
    put = lambda name, rows: spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    put("log", [("s", 1, 1, 0, 0), ("s", 2, 3, 0, 0), ("t", 1, 5, 0, 0)])
    put("tips", [("u", 1, 1, 0, 0)])
    out = live.follow(source("log"), Bridge(Verifier(allow_gaps=False), buffer=4), source("tips"), unload_seconds=0.5)
    query = append(out, f"{tmp_path}/out", f"{tmp_path}/checkpoint", once=False)
    try:
        assert sorted(r.seq for r in waits(query, f"{tmp_path}/out", 2, spark)) == [1, 1]
        held = spark.read.format("statestore").option("stateVarName", "held").option("flattenCollectionTypes", "true").load(f"{tmp_path}/checkpoint")
        assert [r.height for r in held.select("user_map_value.height").collect()] == [3]
        put("tips", [("s", 9, 2, 0, 0)])  # nothing more comes from the log
        assert sorted((r.stream_id, r.seq, r.out_seq) for r in waits(query, f"{tmp_path}/out", 3, spark)) == [("s", 1, 1), ("s", 2, 2), ("t", 1, 1)]
    finally:
        assert stop_between(query)


def test_a_live_chain_goes_on_from_a_table_of_tips(spark, tmp_path):
    rows = [(*r[:8], False) for r in random_log(4, n=60, streams=2)]
    log, tips = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([("0", 20, 2, 0, 0)], "stream_id string, seq long, height long, block_type int, shard_id long")
    log.coalesce(1).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/in")
    append(live.follow(source, Bridge(), tips), f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    got = sorted(map(str, (tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").drop("batch").collect())))
    assert got == sorted(map(str, (tuple(r) for r in chain.fold(chain.with_tips(log, tips), Bridge()).collect())))


MERGE = "stream_id string, input_id int, seq long, height long, hash string, prev_hash string"


def redundant(seed, top=40):
    """Three inputs of one chain, each with gaps, repeats and bad links; heights don't fall."""
    rnd, rows = random.Random(seed), []
    for stream in ("a", None):
        for k in range(3):
            seq = 0
            for h in range(1, top):
                for _ in range(rnd.choice((0, 1, 1, 1, 2))):
                    seq += 1
                    rows.append((stream, k, seq, h, rnd.choice((f"h{h}", f"h{h}", f"H{h}x")), rnd.choice((f"h{h - 1}", f"h{h - 1}", f"h{h - 2}"))))
            rows.append((stream, k, seq + 1, top, f"h{top}", "none"))
    return rows


@pytest.mark.parametrize(("seed", "config"), [(1, {}), (2, {"start_height": 3, "contiguous": True})])
def test_live_inputs_merge_as_tables_do(spark, tmp_path, seed, config):
    rows = redundant(seed)
    inputs = []
    for k in range(3):
        own = [r for r in rows if r[1] == k]
        for i, cut in enumerate(range(0, len(own), 19 + 11 * k)):  # each input grows at its own pace
            spark.createDataFrame(own[cut : cut + 19 + 11 * k], MERGE).coalesce(1).write.parquet(f"{tmp_path}/in{k}/{i:03}")
        inputs.append(spark.readStream.schema(MERGE).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in{k}/*"))
    append(live_merge.merged(inputs, **config), f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    got = sorted(map(str, (tuple(r)[:-1] for r in spark.read.parquet(f"{tmp_path}/out").drop("batch").collect())))
    table = merge.merged(spark.createDataFrame(rows, MERGE), **config)
    want = sorted(map(str, (tuple(r) for r in table.filter("height < 40").select(*spark.createDataFrame([], MERGE).columns).collect())))
    assert got == want and len(want) > 4


def test_a_silent_input_is_not_waited_for(spark, tmp_path):
    put = lambda k, rows: spark.createDataFrame(rows, MERGE).coalesce(1).write.parquet(f"{tmp_path}/in{k}")
    put(0, [("a", 0, h, h, f"h{h}", f"h{h - 1}") for h in range(1, 6)])
    put(1, [("a", 1, h, h, f"h{h}", f"h{h - 1}") for h in range(1, 3)])
    inputs = [spark.readStream.schema(MERGE).parquet(f"{tmp_path}/in{k}") for k in range(2)]
    query = append(live_merge.merged(inputs, patience_seconds=3), f"{tmp_path}/out", f"{tmp_path}/checkpoint", once=False)
    try:
        assert sorted((r.height, r.input_id) for r in waits(query, f"{tmp_path}/out", 5, spark)) == [(h, 0) for h in range(1, 6)]
    finally:
        assert stop_between(query)


def test_silence_by_subject(spark, tmp_path):
    shape = "stream_id string, subject string, seq long"
    put = lambda name, rows: spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    put("log", [("s", "busy", 1), ("s", "quiet", 2), ("s", "done", 3)])
    put("known", [("s", "quiet", 7), ("s", "busy", 1), ("s", "done", 3), (None, "new", 4)])
    source = lambda name: spark.readStream.schema(shape).parquet(f"{tmp_path}/{name}")
    query = append(silence.silences(source("log"), source("known"), 1.0), f"{tmp_path}/out", f"{tmp_path}/checkpoint", once=False)
    try:
        found = waits(query, f"{tmp_path}/out", 2, spark)
        put("log", [("s", "busy", 8), ("s", "quiet", 7)])
        assert {(r.stream_id, r.subject, r.read_seq, r.known_seq) for r in found} == {("s", "quiet", 2, 7), (None, "new", 0, 4)}
        assert all(r.silent_ms >= 1000 for r in found)
    finally:
        assert stop_between(query)


def test_figures_of_the_pass_that_writes(spark, tmp_path):
    rows = spark.range(1, 301).selectExpr("'s' as stream_id", "id as seq", "id div 3 as height", "cast(id % 3 as int) as block_type", "pow(id % 17, 4) as bytes")
    for k in range(3):
        rows.filter(F.col("seq") % 3 == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    edges, told = metrics.exponential(10, 20_000, 5), {}
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    kinds = {str(k): F.col("block_type") == k for k in range(4)}
    append(source, f"{tmp_path}/out", f"{tmp_path}/checkpoint", figures=metrics.observed(F.col("bytes"), edges, kinds), told=told.__setitem__).awaitTermination()
    assert len(told) == 3 and spark.read.parquet(f"{tmp_path}/out").count() == 300
    want = {(r.block_type, r.le): r.n for r in metrics.histogram(rows, F.col("bytes"), ["block_type"], edges).collect()}
    assert {(k, i): sum(t[f"{k}.le_{i}"] for t in told.values()) for k in range(3) for i in range(6)} == want
    for r in metrics.write_figures(rows.withColumn("status", F.lit("OK"))).filter("block_type is not null").collect():
        own = [t for t in told.values() if t[f"{r.block_type}.writes"]]
        assert sum(t[f"{r.block_type}.writes"] for t in own) == r.writes
        assert max((t[f"{r.block_type}.last_seq"], t[f"{r.block_type}.last_height"]) for t in own) == (r.last_seq, r.last_height)
    assert all(t["3.writes"] == 0 and t["3.bytes"] is None for t in told.values())
