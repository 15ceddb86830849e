import random
import re

import pytest
from pyspark.sql import functions as F

from streamchain.operators import chain, prefix, scan, verify
from streamchain.operators.chain import Anchor, Bridge, Fold
from streamchain.operators.tolerance import Counts, Tolerances, counters, first_desync
from streamchain.operators.verify import Verifier
from streamchain.plans import planner, programs

SCHEMA = "stream_id string, seq long, height long, block_type int, shard_id long, hash string, prev_hash string, shard_mask array<boolean>, corrupted boolean"


def random_log(seed, n=120, streams=2, top=14, shards=True):
    rnd = random.Random(seed)
    rows = []
    for s in range(streams):
        for q in range(1, n + 1):
            kind = 0 if q == 1 or not shards else rnd.choice((0, 0, 1, 1, 2)) if seed % 2 else rnd.choice((0, 1))
            height = q // 9 + rnd.randint(-2, 3) if seed % 3 else rnd.randint(0, top)
            rows.append((str(s), q, max(0, height), kind, rnd.randint(0, 4) if kind == 1 else 0, f"h{max(0, height)}", f"h{max(0, height) - rnd.choice((1, 1, 2))}", rnd.choice((None, [], [True, False, True])), rnd.random() < 0.1))
    return rows


def as_dicts(rows, stream):
    names = [f.split()[0] for f in SCHEMA.replace("array<boolean>", "a").split(", ")]
    return [dict(zip(names, r)) for r in rows if r[0] == stream]


def by_hand(rows, bridge):
    out = []
    for s in sorted({r[0] for r in rows}):
        fold = Fold(bridge)
        out += [(s, kept["seq"]) for row in as_dicts(rows, s) for kept in fold.take(row)]
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_records_is_the_fold(spark, seed):
    rows = [(*r[:8], False) for r in random_log(seed)]
    log = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.stream_id, r.seq) for r in chain.records(log, segment=7 + seed).collect())
    assert got == by_hand(rows, Bridge())


@pytest.mark.parametrize("seed", range(3))
def test_island_is_the_unbounded_buffer(spark, seed):
    rows = [(*r[:8], False) for r in random_log(seed, shards=False)]
    log = spark.createDataFrame(rows, SCHEMA)
    got = {(r.stream_id, r.height) for r in chain.island(log).collect()}
    want = by_hand(rows, Bridge(Verifier(allow_gaps=False), buffer=10**6))
    heights = {(r[0], r[1]): r[2] for r in rows}
    assert got == {(s, heights[s, q]) for s, q in want}


CONFIGS = [
    Bridge(Verifier(check_hashes=True)),
    Bridge(Verifier(allow_gaps=False), buffer=3, tolerances=Tolerances(wrong=20)),
    Bridge(Verifier(check_completion=True, check_hashes=True, shard_filter=(True, False, True)), buffer=5),
    Bridge(Verifier(), anchor=Anchor(block=(5, 0, 0)), end_block=(12, 0, 0)),
    Bridge(Verifier(), anchor=Anchor(seq=4), last_block=(9, 1, 2), strict_filter=True),
    Bridge(Verifier(), anchor=Anchor(after=(3, 0, 0)), tolerances=Tolerances(low=3, corrupted=1, no_write=9)),
]


@pytest.mark.parametrize("config", CONFIGS)
def test_fold_in_tasks_is_the_fold(spark, config):
    rows = random_log(4, streams=5)
    log = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = chain.fold(log, config).filter("event = 'written'").orderBy("stream_id", "out_seq").collect()
    assert [(r.stream_id, r.seq) for r in got] == [x for s in map(str, range(5)) for x in _in_order(rows, s, config)]
    assert planner.form(config) == "fold"


@pytest.mark.parametrize("config", [*CONFIGS[:3], CONFIGS[5]])
def test_stretches_give_what_one_fold_gives(spark, config):
    """Rows that a buffer carries over a border, counters that run on, ends, and a stream without name."""
    rows = random_log(4, streams=3)
    log = spark.createDataFrame(rows, SCHEMA).withColumn("more", F.concat(F.lit("m"), "seq")).withColumn("stream_id", F.when(F.col("stream_id") != "2", F.col("stream_id")))
    events = lambda df: sorted((str(r.stream_id), str(r.out_seq), r.seq, r.more, r.event) for r in df.collect())
    whole = chain.written(log, config)
    assert events(chain.written(log, config, stretch=7)) == events(whole)
    assert sorted((r.stream_id or "2", r.seq) for r in whole.filter("event = 'written'").collect()) == by_hand(rows, config)


def test_a_hash_linked_stream_is_spread_over_tasks(spark, monkeypatch):
    """Stretches of a valid chain are folded once, whatever their number, and no shuffle is by stream alone."""
    log = spark.createDataFrame([("s", q, q, f"h{q}", f"h{q - 1}") for q in range(1, 201)], "stream_id string, seq long, height long, hash string, prev_hash string").withColumn("block_type", F.lit(0)).withColumn("shard_id", F.lit(0).cast("long"))
    rounds, left = [], chain._left
    monkeypatch.setattr(chain, "_left", lambda *a: rounds.append(1) or left(*a))
    out = chain.written(log, CONFIGS[0], stretch=10)
    assert len(rounds) == 1 and [r.seq for r in out.orderBy("out_seq").collect()] == list(range(1, 201))
    keys = re.findall(r"hashpartitioning\(([^)]*)\), REPARTITION", out._jdf.queryExecution().executedPlan().toString())
    assert len(keys) == 1 and "__n" in keys[0]


def _in_order(rows, stream, config):
    fold = Fold(config)
    return [(stream, kept["seq"]) for row in as_dicts(rows, stream) for kept in fold.take(row)]


@pytest.mark.parametrize(
    ("buffer", "limits", "heights", "written", "desync"),
    [
        (0, Tolerances(), [1, 2, 3], [1, 2, 3], False),
        (0, Tolerances(), [1, 3, 2, 3], [1, 2, 3], False),
        (2, Tolerances(), [1, 4, 3, 2], [1, 2, 3, 4], False),
        (1, Tolerances(), [1, 4, 3, 2, 5], [1, 2, 3], False),
        (2, Tolerances(wrong=1), [5, 8, 7, 6], [5], True),
        (0, Tolerances(low=2), [9, 8, 7, 6, 10], [9], True),
        (0, Tolerances(low=2), [9, 8, 7, 10], [9, 10], False),
        (0, Tolerances(no_write=0), [1, 1, 2], [1], True),
    ],
)
def test_buffers_and_tolerances(buffer, limits, heights, written, desync):
    fold = Fold(Bridge(Verifier(allow_gaps=False), buffer=buffer, tolerances=limits))
    out = [r["height"] for q, h in enumerate(heights) for r in fold.take({"seq": q, "height": h, "block_type": 0, "shard_id": 0})]
    assert out == written and (fold.ended == "desync") == desync


@pytest.mark.parametrize("verifier", [Verifier(), Verifier(allow_gaps=False, check_hashes=True), Verifier(check_completion=True, check_hashes=True, shard_filter=(True, True, False, True)), Verifier(check_hashes=True, hash_ci=True, shard_filter=())])
def test_reasons_as_columns_and_as_a_function(spark, verifier):
    rows = [(*r[:8], False) for seed in range(4) for r in random_log(seed, 60, 1)]
    rows = [(r[0], i + 1, *r[2:]) for i, r in enumerate(rows)]
    got = {r.seq: r.reason for r in verify.pairwise(spark.createDataFrame(rows, SCHEMA), verifier, segment=13).collect()}
    dicts = as_dicts(rows, "0")
    assert got == {row["seq"]: verifier.reason(last, row) for last, row in zip([None, *dicts], dicts)}
    assert len(set(got.values())) >= 3 or verifier.shard_filter == ()


def test_completion_rules():
    v = Verifier(check_completion=True)
    row = lambda h, s=None, mask=None: {"height": h, "block_type": 0 if s is None else 1, "shard_id": s or 0, "hash": "", "prev_hash": "", "shard_mask": mask}
    m = [True, False, True]
    assert [v.reason(a, b) for a, b in ((row(5, None, m), row(5, 0, m)), (row(5, None, m), row(5, 2, m)), (row(5, 0, m), row(5, 1, m)), (row(5, 2, m), row(5, 3, m)), (row(5, 0, m), row(6)), (row(5, 2, m), row(6)), (row(5, None, []), row(6)))] == ["OK", "ShardGap", "LowShard", "UnwantedShard", "IncompletePreviousBlock", "OK", "OK"]


@pytest.mark.parametrize("seed", range(3))
def test_counters_are_the_fold(spark, seed):
    rnd = random.Random(seed)
    rows = [(str(s), q, rnd.choice(("ok", "low", "high", "corrupted"))) for s in range(3) for q in range(1, 90)]
    log = spark.createDataFrame(rows, "stream_id string, seq long, class string")
    got = {(r.stream_id, r.seq): (r.n_corrupted, r.n_low, r.n_high, r.n_wrong, r.n_no_write) for r in counters(log, segment=11).collect()}
    limits = Tolerances(corrupted=2, low=3, high=3, wrong=4, no_write=6)
    fired = {r.stream_id: (r.seq, r.counter) for r in first_desync(log, limits, segment=11).collect()}
    for s in map(str, range(3)):
        free, bound, first = Counts(Tolerances()), Counts(limits), None
        for stream, q, kind in rows:
            if stream == s:
                free.take(kind)
                assert got[s, q] == tuple(free.now[c] for c in ("corrupted", "low", "high", "wrong", "no_write"))
                if first is None and (c := bound.take(kind)):
                    first = (q, c)
        assert fired.get(s) == first


def test_prefixes_over_segments(spark):
    rnd = random.Random(2)
    rows = [(s, q, rnd.choice((None, rnd.randint(0, 99)))) for s in "ab" for q in range(1, 80) if rnd.random() < 0.8]
    log = spark.createDataFrame(rows, "stream_id string, seq long, v long")
    specs = {"m": ("max", F.col("v")), "l": ("min", F.col("v")), "t": ("sum", F.coalesce("v", F.lit(0))), "p": ("last", F.col("v")), "f": ("first", F.col("v"))}
    for descending in (False, True):
        got = {(r.stream_id, r.seq): (r.m, r.l, r.t, r.p, r.f) for r in prefix.before(log, specs, segment=9, descending=descending).collect()}
        for s, q, _ in rows:
            past = [v for a, b, v in sorted(rows, reverse=descending) if a == s and (b > q if descending else b < q)]
            full = [v for v in past if v is not None]
            assert got[s, q] == (max(full, default=None), min(full, default=None), sum(full), full[-1] if full else None, full[0] if full else None)


def test_empty_logs(spark):
    log = spark.createDataFrame([], SCHEMA)
    assert chain.records(log).collect() == chain.island(log).collect() == chain.fold(log, CONFIGS[1]).collect() == []
    assert verify.pairwise(log, Verifier()).collect() == [] and programs.validate(log).collect() == []


def test_no_window_holds_a_whole_stream(spark, sf):
    from streamchain.sources.adapters import event_log

    log = event_log(spark, sf).withColumn("block_type", F.lit(0)).withColumn("shard_id", F.lit(0).cast("long"))
    plan = chain.records(log)._jdf.queryExecution().optimizedPlan().toString()
    over_rows = [line for line in plan.splitlines() if "Window [" in line and "__local" in line]
    assert over_rows and all("__segment" in line for line in over_rows)


@pytest.mark.parametrize("config", [Bridge(), Bridge(Verifier(check_hashes=True)), Bridge(Verifier(allow_gaps=False), buffer=4), Bridge(last_block=(12, 0, 0)), Bridge(Verifier(shard_filter=(True, False, True)), end_block=(11, 0, 0))])
def test_resumed_where_it_stopped(spark, config):
    """A first run's output and what a second one appends to it: as one run, but for what a buffer held in between."""
    rows = [(*r[:8], False) for r in random_log(4, streams=3)]
    log = spark.createDataFrame(rows, SCHEMA).withColumn("stream_id", F.when(F.col("stream_id") != "2", F.col("stream_id")))
    for cut in (1, 20, 63):
        begun = programs.bridge(log.filter(F.col("seq") <= cut), config)
        rest = programs.bridge(log, config, begun)
        want = []
        for s in "012":
            own = as_dicts(rows, s)
            fold = Fold(config)
            first = [k for r in own if r["seq"] <= cut for k in fold.take(r)]
            tip = first[-1] if first else None
            after = Fold(config, tip)
            start = 0 if tip is None else tip["seq"] + 1 if not config.buffer else min((r["seq"] for r in own if chain.block_key(r) > chain.block_key(tip)), default=0)
            second = [k for r in own if r["seq"] >= start for k in after.take(r)]
            want += [(s if s != "2" else "None", k["seq"]) for k in first + second]
        assert sorted((str(r.stream_id), r.seq) for r in begun.unionByName(rest).collect()) == sorted(want)
    assert programs.bridge(log, config, log.limit(0)).count() == programs.bridge(log, config).count()


def test_a_stray_row_after_the_tip(spark):
    rows = [("s", 1, 10, "a", ""), ("s", 2, 11, "b", "a"), ("s", 3, 5, "z", "y"), ("s", 4, 12, "c", "b")]
    log = spark.createDataFrame(rows, "stream_id string, seq long, height long, hash string, prev_hash string").withColumn("block_type", F.lit(0)).withColumn("shard_id", F.lit(0).cast("long"))
    for config in (Bridge(), Bridge(Verifier(check_hashes=True))):
        assert [r.seq for r in programs.bridge(log, config, log.filter("seq <= 2")).collect()] == [4]


@pytest.mark.parametrize("config", [*CONFIGS, Bridge(), Bridge(Verifier(shard_filter=(True, False)))])
def test_rows_without_a_block(spark, config):
    """Nulls beside numbers leave these as they are, also where doubles can't tell them apart."""
    far = (1 << 53) + 1
    rows = [(r[0], r[1], *((None,) * 6 if r[1] % 7 == 3 else (r[2] + far, *r[3:8])), r[1] % 7 == 3 or r[8]) for r in random_log(4, streams=2)]
    shift = lambda b: None if b is None else (b[0] + far, *b[1:])
    anchor = Anchor(shift(config.anchor.block), shift(config.anchor.after), config.anchor.seq)
    config = Bridge(config.verifier, config.buffer, config.tolerances, anchor, shift(config.last_block), shift(config.end_block), config.strict_filter)
    got = sorted((r.stream_id, r.seq, r.height) for r in planner.rows(spark.createDataFrame(rows, SCHEMA), config).collect())
    assert got == sorted((s, k["seq"], k["height"]) for s in "01" for k in (k for fold in [Fold(config)] for r in as_dicts(rows, s) for k in fold.take(r)))


def test_derived_logs_are_numbered_by_cells(spark, sf):
    from streamchain.sources import adapters

    plan = adapters._chain_log(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and ("row_number" in line or "__local" in line)]
    assert windows and all("cell" in line or "__segment" in line for line in windows)


def test_ranges_of_a_stored_log_reach_its_scan(spark, sf):
    from streamchain import catalog

    plan = catalog.queries()["scan_range"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(seq,100), LessThan(seq,400)" in plan and "Exchange" not in plan


def plain_reorder(rows, size, wrong_most):
    """Heights in their order, with a buffer of so many rows and a limit for rows in a row that are corrupted or too high; from the rules, with no code of the package."""
    tip, held, wrong, out, ended = None, [], 0, [], None
    for seq, height, corrupted in rows:
        for turn in (0, 1):
            waiting, held = sorted(held)[:size], []
            for h, q in waiting:
                if tip is not None and h == tip + 1:
                    tip = h
                    out.append(q)
                elif tip is not None and h > tip + 1:
                    held.append((h, q))
            if turn:
                break
            if not corrupted and (tip is None or height == tip + 1):
                tip, wrong = height, 0
                out.append(seq)
            elif not corrupted and height <= tip:
                wrong = 0
            else:
                if not corrupted:
                    held.append((height, seq))
                if wrong == wrong_most:
                    ended = seq
                    break
                wrong += 1
        if ended is not None:
            break
    return out, ended


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_the_reorder_query_against_plain_rules(spark, folder):
    from streamchain import catalog
    from streamchain.sources.adapters import event_log

    got, want = {}, {}
    for r in catalog.queries()["chain_reorder"](spark, folder).collect():
        got.setdefault(r.stream_id, []).append((r.out_seq, r.seq, r.event))
    logs = {}
    for r in event_log(spark, folder).select("stream_id", "seq", "height", "corrupted").collect():
        logs.setdefault(str(r.stream_id), []).append((r.seq, r.height, r.corrupted))
    for s, rows in logs.items():
        out, ended = plain_reorder(sorted(rows), 16, 500)
        want[s] = [(k, q, "written") for k, q in enumerate(out, 1)] + ([(None, ended, "desync")] if ended is not None else [])
    assert {s: sorted(x, key=str) for s, x in got.items()} == {s: sorted(x, key=str) for s, x in want.items() if x}


@pytest.mark.parametrize("seed", range(4))
def test_small_buffers_and_limits_against_plain_rules(seed):
    rnd = random.Random(seed)
    rows = [(q, max(0, q // 2 + rnd.randint(-4, 6)), rnd.random() < 0.15) for q in range(1, 300)]
    for size, wrong in ((0, 3), (1, 5), (3, 9), (7, 40), (50, 10**6)):
        fold = Fold(Bridge(Verifier(allow_gaps=False), buffer=size, tolerances=Tolerances(wrong=wrong)))
        out, ended = [], None
        for q, h, bad in rows:
            was = fold.ended
            out += [r["seq"] for r in fold.take({"seq": q, "height": h, "block_type": 0, "shard_id": 0, "corrupted": bad})]
            ended = q if fold.ended and not was else ended
        assert (out, ended) == plain_reorder(rows, size, wrong)


@pytest.mark.parametrize("n", [500, 2000])
def test_a_large_buffer_is_not_gone_through_for_every_row(n, monkeypatch):
    """Rows that wait are judged when the tip comes to them, not again and again."""
    asked = []
    plain = Verifier.reason
    monkeypatch.setattr(Verifier, "reason", lambda self, last, row: asked.append(1) or plain(self, last, row))
    fold = Fold(Bridge(Verifier(allow_gaps=False), buffer=10**6))
    rows = [{"seq": q, "height": h, "block_type": 0, "shard_id": 0} for q, h in enumerate([0, *range(n, 1, -1), 1], 1)]
    out = [r["height"] for row in rows for r in fold.take(row)]
    assert out == list(range(n + 1)) and len(asked) <= 4 * n


def _few_and_many(monkeypatch):
    calls = []
    left = chain._left
    monkeypatch.setattr(chain, "_left", lambda *args: calls.append(1) or left(*args))
    return calls


@pytest.mark.parametrize("config", [CONFIGS[0], CONFIGS[1], Bridge(Verifier(allow_gaps=False), buffer=10**6), Bridge(Verifier(shard_filter=(True, False)))])
def test_short_streams_are_not_cut(spark, monkeypatch, config):
    """Streams whose few rows lie far apart are folded at once."""
    calls = _few_and_many(monkeypatch)
    rows = [(r[0], r[1] * 1000, *r[2:]) for r in random_log(4)]
    got = chain.written(spark.createDataFrame(rows, SCHEMA), config, stretch=500).filter("event = 'written'").collect()
    assert sorted((r.stream_id, r.seq) for r in got) == by_hand(rows, config) and not calls


@pytest.mark.parametrize("config", [CONFIGS[0], Bridge(Verifier(check_hashes=True), last_block=(7, 0, 0)), Bridge(Verifier(allow_gaps=False), buffer=3)])
def test_a_chain_that_is_stuck_is_folded_twice(spark, monkeypatch, config):
    """Guesses that never hold don't make a round for every stretch."""
    calls = _few_and_many(monkeypatch)
    rows = [(s, q, q if q != 40 else 90, 0, 0, f"h{q}", f"h{q - 1 - (q == 40)}", None, False) for s in "01" for q in range(1, 200)]
    got = chain.written(spark.createDataFrame(rows, SCHEMA), config, stretch=8).filter("event = 'written'").collect()
    assert sorted((r.stream_id, r.seq) for r in got) == by_hand(rows, config) and len(calls) <= 3
    outs = {s: [r.seq for r in sorted(got, key=lambda r: r.out_seq) if r.stream_id == s] for s in "01"}
    assert outs["0"] == outs["1"] and [r.out_seq for r in got if r.stream_id == "0"] and {r.out_seq for r in got} == set(range(1, len(outs["0"]) + 1))


def test_stored_logs_hold_no_hashes_and_their_rows_move_once(spark, sf):
    from streamchain.sources import adapters

    made = adapters._noisy_log(spark, sf)
    plan = made._jdf.queryExecution().executedPlan().toString()
    by_cell = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "cell" in line]
    assert not {"hash", "prev_hash"} & set(made.columns) and len(by_cell) == 1
    assert {"hash", "prev_hash"} < set(adapters.noisy_log(spark, sf).columns)


def _moves(df):
    """Exchanges of a plan that move rows between tasks."""
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(" in line]


def _places(df):
    return sorted((str(r.stream_id), str(r.seq)) for r in df.select("stream_id", "seq").collect())


def test_a_log_isnt_moved_to_be_cut_at_a_time(spark):
    rows = [(s, q, t) for s in ("a", None) for q, t in ((None, 0), (1, None), (2, 5), (3, 9), (4, 1), (5, 9))] + [("low", 1, 1), ("high", None, 9), ("high", 1, 1)]
    out = scan.until_time(spark.createDataFrame(rows, "stream_id string, seq long, ts long"), 9)
    assert not _moves(out)
    assert _places(out) == sorted([(str(s), str(q)) for s in ("a", None) for q in (None, 1, 2)] + [("low", "1")])


def test_a_log_isnt_moved_to_be_anchored(spark):
    rows = [(s, q, h, k, 0) for s in ("a", None) for q, h, k in ((None, 1, 0), (1, None, 0), (2, 5, 1), (3, 5, 0), (4, 2, 0), (5, 5, 0))] + [("none", 1, 1, 0, 0)]
    log = spark.createDataFrame(rows, "stream_id string, seq long, height long, block_type int, shard_id long")
    for anchor in (chain.Anchor(block=(5, 0, 0)), chain.Anchor(after=(4, 0, 0))):
        out = chain.anchored(log, anchor)
        assert not _moves(out)
        assert _places(out) == sorted((str(s), str(q)) for s in ("a", None) for q in (3, 4, 5))


def test_hashes_are_made_after_a_linked_log_is_stored(spark, sf):
    from streamchain import catalog
    from streamchain.sources import adapters

    catalog.queries()["chain_hash_linked"](spark, sf)
    path, schema = adapters._STORED[spark.sparkContext.applicationId, sf, "linked_log"]
    assert "before" in schema.names and not {"hash", "prev_hash"} & set(schema.names)
