import pytest
from pyspark.sql import functions as F

from streamchain.functions.headers import copied, preserve
from streamchain.operators import merge, metrics, retention, scan, seek, sink
from streamchain.plans import programs
from streamchain.sources import decode, files


def test_read_what_was_written(spark, tmp_path):
    log = spark.createDataFrame([(s, q, f"{s}{q}") for s in "ab" for q in range(1, 30)], "stream_id string, seq long, v string")
    files.write(log, f"{tmp_path}/log", segment=10)
    got = files.read(spark, f"{tmp_path}/log")
    assert sorted(map(tuple, got.select("stream_id", "seq", "v").collect())) == sorted(map(tuple, log.collect()))
    plan = scan.between(got, 5, 9)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(seq), GreaterThanOrEqual(seq,5), LessThan(seq,9)]" in plan


@pytest.mark.parametrize("kind", ["json_lz4", "cbor_map", "proto_zstd"])
def test_payload_round_trips(spark, kind):
    blocks = [(q, 1000 * q, 0 if kind != "proto_zstd" or q % 2 else 1, 0 if kind != "proto_zstd" or q % 2 else q, f"h{q}", f"p{q}", None if kind != "proto_zstd" or q % 3 else [True, False]) for q in range(1, 20)]
    t = spark.createDataFrame(blocks, "seq long, height long, block_type byte, shard_id long, hash string, prev_hash string, shard_mask array<boolean>")
    back = decode.decode(decode.encode(t, kind).select("seq", "data"), kind)
    assert sorted(tuple(r)[:7] for r in back.collect()) == blocks and back.filter("decode_error is not null").count() == 0


@pytest.mark.parametrize("kind", ["json_lz4", "cbor_map", "proto_zstd"])
def test_bad_payloads_become_errors(spark, kind):
    good = decode.encode_one({"height": 5, "block_type": 0, "shard_id": 0, "hash": "a", "prev_hash": "b"}, kind)
    bad = [None, b"", b"\x02", b"\x01", b"\x01\x80", good[:-3], b"\xff" * 40, b"\x01" + decode.write_cbor([1]) + decode.write_cbor({"hash": 1})]
    t = spark.createDataFrame([(k, None if b is None else bytearray(b)) for k, b in enumerate(bad)], "seq long, data binary")
    got = decode.decode(t, kind).collect()
    assert len(got) == len(bad) and all(r.decode_error and r.height is None for r in got)


def test_plain_messages_are_coded_by_columns(monkeypatch):
    """As row by row, whatever the payload; and no plain one goes row by row."""
    import random

    import pyarrow as pa
    import zstandard

    pick = random.Random(1)
    blocks = [
        {"height": pick.choice([0, 127, 128, 2**35 + k, 2**63 - 1]), "block_type": k % 3, "shard_id": pick.choice([0, k, 2**40]), "hash": "h" * pick.choice([0, 1, 32, 200]), "prev_hash": f"{k}" * (k % 4)}
        for k in range(300)
    ]
    batch = pa.RecordBatch.from_pylist(blocks, pa.schema([("height", pa.int64()), ("block_type", pa.int32()), ("shard_id", pa.int64()), ("hash", pa.string()), ("prev_hash", pa.string())]))
    sent = decode._written_columns(batch.slice(7))
    assert sent == [decode.encode_one(b, "proto_zstd") for b in blocks[7:]]
    for bad in ({"height": -1}, {"height": None}, {"hash": None}, {"hash": "x" * 5000}):
        assert decode._written_columns(pa.RecordBatch.from_pylist([blocks[0] | bad], batch.schema)) is None
    masked = [decode.encode_one(b | {"shard_mask": [True, False][: k % 3]}, "proto_zstd") for k, b in enumerate(blocks)]
    press = zstandard.ZstdCompressor(level=1).compress
    odd = [None, b"", sent[0][:-3], sent[0] + b"rest", b"\xff" * 40, press(b""), press(b"\x0a\x03\x0a\x01"), press(b"\x1a\x00"), press(b"\x08\x01"), press(b"\x12\x02\x35\x01"), press(b"\x0a\x0b\x18" + b"\xff" * 9 + b"\x01"),
           press(b"\x0a\x06\x30\x05\x18\x01\x18\x02tail"), press(b"\x0a\x82\x27\x0a\xff\x26" + b"a" * 4991), press(b"\x0a\x00")]
    for _ in range(3000):  # messages with a byte changed or their end cut off, where reading by rows copes with them
        m = bytearray(zstandard.ZstdDecompressor().decompress(pick.choice(masked)))
        m[pick.randrange(len(m))] = pick.randrange(128)
        p = press(bytes(m[: pick.choice([len(m), pick.randrange(1, len(m) + 1)])]))
        try:
            decode._read_rows([p], "proto_zstd")
        except (TypeError, AttributeError, UnicodeEncodeError):
            continue
        odd.append(p)
    every = [*odd, *sent, *masked]
    pick.shuffle(every)
    for some in (every, odd, odd[:2], sent):
        assert [a.to_pylist() for a in decode._read(pa.array([None, *some], pa.binary()).slice(1), "proto_zstd")] == [a.to_pylist() for a in decode._read_rows(some, "proto_zstd")]
    assert [a.type for a in decode._read(pa.array(sent, pa.binary()), "proto_zstd")] == list(decode._ARROW)
    monkeypatch.setattr(decode, "decode_one", None)
    assert decode._read(pa.array(sent + masked), "proto_zstd")[0].null_count == 0


def test_cbor():
    for value in (0, 23, 24, 255, 256, 65536, 2**40, -1, -500, b"", b"x" * 300, "é", [1, [2, b"3"]], {"a": {"b": [1]}}):
        assert decode.read_cbor(decode.write_cbor(value)) == (value, len(decode.write_cbor(value)))


def test_writes(spark):
    out = spark.createDataFrame([("s", q, f"{q}") for q in (98, 99, 100)], "stream_id string, seq long, msg_id string")
    cases = {(100, "", "101"): "OK/success", (100, "100", "101"): "OK/success", (100, "7", "101"): "WrongPredecessor/collision", (99, "99", "100"): "OK/duplicate", (98, "x", "100"): "Collision/collision", (98, "98", "x"): "Collision/collision", (96, "", "x"): "RemovedPosition/desync", (150, "", "x"): "WrongPredecessor/collision"}
    requests = spark.createDataFrame([("s", m, p, i) for p, i, m in cases], "stream_id string, msg_id string, pred_seq long, pred_msg_id string")
    got = {(r.pred_seq, r.pred_msg_id, r.msg_id): f"{r.outcome}/{r.status}" for r in sink.classify_writes(requests, out).collect()}
    assert got == cases
    empty = {(0, "", "1"): "OK/success", (0, "x", "1"): "WrongPredecessor/collision", (3, "", "1"): "WrongPredecessor/collision"}
    requests = spark.createDataFrame([("s", m, p, i) for p, i, m in empty], "stream_id string, msg_id string, pred_seq long, pred_msg_id string")
    got = {(r.pred_seq, r.pred_msg_id, r.msg_id): f"{r.outcome}/{r.status}" for r in sink.classify_writes(requests, out.limit(0)).collect()}
    assert got == empty


def test_seek_plans():
    assert seek.plan((5, 0, 0), 0, 9)["only_greater"] and seek.plan(None, 10, 9, anchor=(5, 0, 0)) == {"seek": "block", "target": (5, 0, 0), "only_greater": False}
    assert seek.plan(None, 1, 0, anchor_input_seq=7) == {"seek": "seq", "target": 7}
    for args in ((None, 0, 9), (None, 5, 9), (None, 10, 9)):
        with pytest.raises(ValueError):
            seek.plan(*args)


def test_headers(spark):
    t = spark.sql("select map('Nats-Msg-Id', array('1'), 'nats-X', array('y'), 'Own', array('a'), 'S', array('3')) as h, 9 as seq")
    r = t.select(copied(F.col("h"), F.col("seq"), "S").alias("kept"), copied(F.col("h"), F.col("seq"), "S", True).alias("dropped"), preserve(F.col("h"), F.lit("7")).alias("new")).first()
    assert r.kept == {"Nats-Msg-Id": ["1"], "Own": ["a"], "S": ["9"]} and r.dropped == {"Own": ["a"], "S": ["9"]}
    assert r.new == {"nats-X": ["y"], "Own": ["a"], "S": ["3"], "Nats-Msg-Id": ["7"]}


def test_copy_resumes(spark):
    log = spark.createDataFrame([("s", q, {"K": ["v"]}, "in") for q in range(1, 11)], "stream_id string, seq long, headers map<string,array<string>>, subject string")
    first = programs.copy(log, None, programs.Copy(end_seq=5))
    rest = programs.copy(log, first, programs.Copy(subject="out"))
    assert sorted(r.seq for r in first.collect()) == [1, 2, 3, 4] and sorted(r.seq for r in rest.collect()) == list(range(5, 11))
    assert {r.subject for r in rest.collect()} == {"out"}


def test_retention(spark):
    log = spark.createDataFrame([(s, q, 10) for s in "ab" for q in range(1, 31)], "stream_id string, seq long, bytes long")
    for segment in (4, 1 << 20):
        assert sorted(r.seq for r in retention.newest_messages(log, 3, segment).filter("stream_id = 'a'").collect()) == [28, 29, 30]
        assert retention.newest_bytes(log, 55, F.col("bytes"), segment).count() == 10
    assert [r.limit_bytes for r in retention.shrink_steps(spark, 5, 100, 70, 20).collect()] == [80, 70]
    assert [r.limit_bytes for r in retention.shrink_steps(spark, 5, 0, 70, 20).collect()] == [70] and retention.shrink_steps(spark, 5, 60, 70, 20).collect() == []
    assert retention.size_limit(kb=0, mb=3) == 3 << 20
    with pytest.raises(ValueError):
        retention.size_limit(kb=1, gb=1)


def test_mirrors_far_and_round(spark):
    rows = [("s0", None, "x")] + [(f"s{k}", f"s{k - 1}", None) for k in range(1, 200)] + [("a", "b", None), ("b", "a", None), ("into", "a", None), ("lost", "nowhere", None)]
    got = {r.stream: r.steps for r in scan.resolve_mirrors(spark.createDataFrame(rows, "stream string, mirror_of string, subjects string")).collect()}
    assert got == {f"s{k}": k for k in range(200)}


MERGE = "stream_id string, input_id string, height long, hash string, prev_hash string, seq long"


def merged_by_hand(rows, start=0, contiguous=False):
    out = []
    for s in sorted({r[0] for r in rows}, key=str):
        head = None
        for r in sorted((r for r in rows if r[0] == s and r[2] is not None), key=lambda r: (r[2], r[1], r[5])):
            if head is None:
                fits = r[2] == start if start else True
            else:
                fits = r[2] > head[2] and (not contiguous or r[2] == head[2] + 1) and (r[4] or "") == (head[3] or "")
            if fits:
                head = r
                out.append(r)
    return out


def test_merge_takes_the_other_input_where_one_is_broken(spark):
    rows = [("s", "a", 1, "h1", "", 1), ("s", "a", 2, "x2", "bad", 2), ("s", "a", 3, "h3", "h2", 3), ("s", "b", 1, "h1", "", 1), ("s", "b", 2, "h2", "h1", 2), ("s", "b", 3, "h3", "h2", 3)]
    got = merge.merged(spark.createDataFrame(rows, MERGE))
    assert sorted((r.height, r.input_id) for r in got.collect()) == [(1, "a"), (2, "b"), (3, "a")]


def test_merge_of_a_stream_without_name_over_stretches(spark):
    rows = [(s, "a", h, f"h{h}", f"h{h - 1}", h) for s in ("s", None) for h in range(1, 9)]
    got = merge.merged(spark.createDataFrame(rows, MERGE), stretch=2, segment=3)
    assert sorted((str(r.stream_id), r.height) for r in got.collect()) == [(s, h) for s in ("None", "s") for h in range(1, 9)]


@pytest.mark.parametrize("seed", range(3))
def test_merges_are_the_walk(spark, seed):
    import random

    rnd = random.Random(seed)
    rows = []
    for s in ("s", None):
        for q in range(90):
            h = q // 3 + rnd.choice((0, 0, 0, 1))
            rows.append((s, rnd.choice("abc"), rnd.choice((h, h, h, None)) if q % 10 == 9 else h, rnd.choice((f"h{h}", f"h{h}", f"h{h}'", None)), rnd.choice((f"h{h - 1}", f"h{h - 1}", f"h{h - 2}", f"h{h - 1}'")), q))
    t = spark.createDataFrame(rows, MERGE)
    for stretch, contiguous, start in ((1, False, 0), (7, False, 3), (1 << 16, True, 0)):
        out = merge.merged(t, start, contiguous, stretch=stretch, segment=5)
        assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, merged_by_hand(rows, start, contiguous)))
    counts = merge.merge_counts(t, merge.merged(t), segment=4).collect()
    assert sum(r.handled for r in counts) == len(rows) and sum(r.written for r in counts) == len(merged_by_hand(rows))
    assert all(r.handled == r.corrupted + r.written + r.low + r.high + r.mismatch for r in counts) and sum(r.corrupted for r in counts) == sum(r[2] is None for r in rows)


def test_copies_after_the_window_are_new(spark):
    times = [0, 30, 60, 90, 110, 119, 121, 200, 240, 241, 500]
    d = spark.createDataFrame([("s" if k % 2 else None, q, 1, 0, 0, t) for k in (0, 1) for q, t in enumerate(times)], "stream_id string, seq long, height long, block_type int, shard_id long, t int")
    got = merge.deduplicate_within(d.withColumn("ts", F.timestamp_seconds("t")), segment=4).collect()
    assert sorted((str(r.stream_id), r.t) for r in got) == sorted((s, t) for s in ("None", "s") for t in (0, 121, 241, 500))


def test_rows_without_stream_or_place(spark):
    log = spark.createDataFrame([(s, q, q) for s in ("a", None) for q in (1, 2, None)], "stream_id string, seq long, height long")
    assert sorted((str(r.stream_id), str(r.seq), str(r.tip)) for r in metrics.running_tip(log).collect()) == sorted((str(s), str(q), str(q)) for s in ("a", None) for q in (1, 2, None))
    assert retention.newest_messages(log, 10).count() == 6
    points = spark.createDataFrame([(None, 7)], "stream_id string, point int")
    for most in (0, 9):
        assert sorted(str(r.point) for r in sink.by_stream(log, points, most).collect()) == ["7"] * 3 + ["None"] * 3


def test_payloads_byte_by_byte(spark):
    """Payloads written out from the formats' definitions, not by this package's own encoder."""
    import xxhash

    def frame(body):
        head = b"\x60\x40"  # independent blocks of 64 KB at most, no checksums
        raw = (len(body) | 1 << 31).to_bytes(4, "little") + body  # not compressed
        return b"\x04\x22\x4d\x18" + head + bytes([xxhash.xxh32_intdigest(head) >> 8 & 255]) + raw + bytes(4)

    envelope = bytes.fromhex("01 85 02 18 2a 1a 65 00 00 00 19 01 f4 50") + bytes(16)
    cbor = envelope + b"\xa3\x64hash\x62aa\x6bparent_hash\x62bb\x66height\x19\x01\x00"
    body = frame(b'{"block": {"header": {"height": 300, "prev_hash": "p", "hash": "h"}}}')
    json_ = envelope + bytes([0x58, len(body)]) + body
    inner = b"\x0a\x01h\x12\x01p\x18\xac\x02\x22\x02\x01\x00\x28\x07"
    message = b"\x12" + bytes([len(inner)]) + inner
    zstd = b"\x28\xb5\x2f\xfd\x20" + bytes([len(message)]) + (len(message) << 3 | 1).to_bytes(3, "little") + message
    want = {"cbor_map": (256, 0, 0, "aa", "bb", None), "json_lz4": (300, 0, 0, "h", "p", None), "proto_zstd": (300, 1, 7, "h", "p", [True, False])}
    for kind, data in (("cbor_map", cbor), ("json_lz4", json_), ("proto_zstd", zstd)):
        r = decode.decode(spark.createDataFrame([(1, bytearray(data))], "seq long, data binary"), kind).first()
        assert (r.height, r.block_type, r.shard_id, r.hash, r.prev_hash, r.shard_mask) == want[kind] and r.decode_error is None


def test_histogram_edges(spark):
    t = spark.createDataFrame([(v,) for v in (0, 10, 11, 20, 99)], "v long")
    got = {r.le: r.n for r in metrics.histogram(t, F.col("v"), [], [10.0, 20.0]).collect()}
    assert got == {0: 2, 1: 4, 2: 5}
    assert metrics.linear(1, 2, 3) == [1, 3, 5] and metrics.exponential(1, 100, 3) == pytest.approx([1, 10, 100])


def test_only_writes_that_ask_for_a_place_are_moved_for_it(spark):
    """Requests of known ids, and those at or beyond the end, would all meet in the place after the last row."""
    rows = [(s, q, f"{q}") for s in ("s", None) for q in range(1, 201)]
    out = spark.createDataFrame(rows, "stream_id string, seq long, msg_id string")
    requests = spark.createDataFrame([(s, m, q, "") for s in ("s", None) for q, m in [(200, f"n{k}") for k in range(300)] + [(k, f"{k + 1}") for k in range(200)] + [(5, "other")]], "stream_id string, msg_id string, pred_seq long, pred_msg_id string")
    got = sink.classify_writes(requests, out)
    counts = {(r.stream_id, r.outcome, r.status): r["count"] for r in got.groupBy("stream_id", "outcome", "status").count().collect()}
    assert counts == {(s, *k): n for s in ("s", None) for k, n in {("OK", "success"): 300, ("OK", "duplicate"): 200, ("Collision", "collision"): 1}.items()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan  # those that ask for no place pass beside the join


def test_a_merge_moves_what_it_gives_out(spark):
    rows = [(s, i, h, f"h{h}", f"h{h - 1}", h, "wide") for s in ("s", None) for i in "ab" for h in range(1, 9)]
    t = spark.createDataFrame(rows, f"{MERGE}, rest string")
    out = merge.merged(t, columns=merge.TURN, stretch=2, segment=3)
    assert out.columns == list(merge.TURN)
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, (tuple(r) for r in merge.merged(t).select(*merge.TURN).collect())))
    counts = merge.merge_counts(t, out, segment=3)
    assert sorted((r.input_id, r.handled, r.written, r.low) for r in counts.collect()) == [("a", 16, 16, 0), ("b", 16, 0, 16)]


def judged_by_hand(rows, start=0, contiguous=False):
    """Counts by input of rows as MERGE has them, with corrupted."""
    from collections import Counter

    counts, heads = Counter(), {}
    for r in sorted(rows, key=lambda r: (r[2] is not None, r[2], r[1], r[5])):
        head = heads.get(r[0])
        if r[2] is None or r[6]:
            kind = "corrupted"
        elif head is None:
            kind = "low" if r[2] < start else "high" if start and r[2] > start else "written"
        elif r[2] <= head[2]:
            kind = "low"
        elif contiguous and r[2] > head[2] + 1:
            kind = "high"
        else:
            kind = "written" if (r[4] or "") == (head[3] or "") else "mismatch"
        if kind == "written":
            heads[r[0]] = r
        counts[r[1], kind] += 1
        counts[r[1], "handled"] += 1
    return dict(counts)


@pytest.mark.parametrize(("stretch", "start", "contiguous", "few"), [(3, 0, False, 100), (4, 5, False, 0), (5, 0, True, 100)])
def test_rows_of_a_merge_are_counted_as_it_is_walked(spark, monkeypatch, stretch, start, contiguous, few):
    """Hashes come back at other heights, streams begin late or not at all, rows are corrupted or have no height, and turns repeat."""
    import random

    rnd = random.Random(stretch)
    rows = []
    for s in ("s", "t", None):
        for q in range(150):
            h = 2 + q // 8 + (9 if s == "t" else 0)
            x, prev = rnd.choice((f"h{h}", f"h{h}", f"h{h}", f"h{h % 4}", None)), rnd.choice((f"h{h - 1}", f"h{h - 1}", f"h{h - 2}", f"h{h % 4}", ""))
            rows.append((s, rnd.choice("ab"), rnd.choice((h, h, h, h, h, h, None)), x, prev, q, rnd.choice((False, False, False, True, None))))
    rows.append(rows[40])
    monkeypatch.setattr(merge, "FEW_STREAMS", few)
    t = spark.createDataFrame(rows, f"{MERGE}, corrupted boolean")
    got = merge.merge_counts(t, start_height=start, contiguous=contiguous, stretch=stretch, segment=7).collect()
    want = judged_by_hand(rows, start, contiguous)
    assert sum(n for (_, k), n in want.items() if k == "written") > 5
    assert {(r.input_id, k): r[k] for r in got for k in ("handled", "corrupted", "written", "low", "high", "mismatch") if r[k]} == want


def test_counting_a_merge_moves_its_blocks_once_a_pass_and_narrow(spark, sf):
    from streamchain import catalog
    from streamchain.sources import adapters

    blocks = adapters.chain_held(spark, sf).filter("block_type = 0").count()

    def moved():
        context = spark.sparkContext
        stages = context._jsc.sc().statusStore().stageList(None, False, False, context._gateway.new_array(context._jvm.double, 0), context._jvm.java.util.ArrayList())
        found = [stages.apply(k) for k in range(stages.size())]
        return sum(s.shuffleWriteRecords() for s in found), sum(s.shuffleWriteBytes() for s in found)

    records, size = moved()
    catalog.queries()["merge_counters_from_start"](spark, sf).collect()
    records, size = (now - then for now, then in zip(moved(), (records, size), strict=True))
    assert records < 4 * blocks and size < 100 * blocks  # two hashes alone are 64 bytes a candidate


def test_tasks_of_the_join_of_lines_follow_their_number(spark, sf, monkeypatch):
    from streamchain.sources import adapters

    plain = sorted(map(tuple, adapters._rows(spark, sf).collect()), key=str)
    monkeypatch.setattr(adapters, "PLACED", 100)
    dealt = adapters._rows(spark, sf)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert f", {-(-lines // 100)})" in plan and "REPARTITION_BY_NUM" in plan
    assert sorted(map(tuple, dealt.collect()), key=str) == plain
