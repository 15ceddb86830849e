import itertools

import pytest
from pyspark.sql import functions as F

from streamchain.functions import headers, msgid, shardmask


def test_message_ids(spark):
    cases = {"5": (5, 0, 0), "7.3": (7, 1, 3), "0.18446744073709551615": (0, 1, 2**64 - 1), "": None, "1.": None, ".1": None, "1.2.3": None, " 1": None, "+1": None, "1.18446744073709551616": None, "99999999999999999999999": None, "00018446744073709551615": (2**64 - 1, 0, 0)}
    t = spark.createDataFrame([(k,) for k in cases] + [(None,)], "id string").withColumn("p", msgid.parse(F.col("id")))
    for r in t.collect():
        got = None if r.p.error else (int(r.p.height), r.p.block_type, int(r.p.shard_id))
        assert got == cases.get(r.id), r.id


def test_block_order(spark):
    blocks = [(h, t, s) for h in (1, 2) for t, s in ((0, 0), (0, 7), (1, 0), (1, 50), (2, 9))]
    t = spark.createDataFrame(blocks, "h long, t int, s long").select("h", "t", "s", msgid.order_key(F.col("h"), F.col("t"), F.col("s")).alias("k"))
    keys = {(r.h, r.t, r.s): tuple(r.k) for r in t.collect()}
    for a, b in itertools.product(blocks, blocks):
        less = (a[0], a[1], a[2] if a[1] == 1 else 0) < (b[0], b[1], b[2] if b[1] == 1 else 0)
        assert (keys[a] < keys[b]) == less


@pytest.mark.parametrize(("text", "mask"), [("", None), ("-", ""), ("0", "1"), ("1-2,4", "01101"), (" 3 ", "0001"), ("1 - 3", "0111")])
def test_shard_masks(spark, text, mask):
    r = spark.range(1).select(shardmask.parse(F.lit(text)).alias("p")).first().p
    shown = None if r.mask is None else "".join("01"[b] for b in r.mask)
    own = shardmask.parse_text(text)
    assert r.error is None and shown == mask == (None if own is None else "".join("01"[b] for b in own))


@pytest.mark.parametrize("text", [" ", "- ", "1,,2", "3-1", "1-2-", "x", "10001", "-1", "1-"])
def test_bad_shard_masks(spark, text):
    assert spark.range(1).select(shardmask.parse(F.lit(text)).alias("p")).first().p.error
    with pytest.raises(ValueError, match="invalid"):
        shardmask.parse_text(text)


def test_filters_tell_null_from_empty(spark):
    t = spark.sql("select * from values (cast(null as array<boolean>), 3), (array(), 0), (array(false, true), 1), (array(true), 5) as t(f, i)")
    assert [r[0] for r in t.select(shardmask.passes(F.col("f"), F.col("i"))).collect()] == [True, False, True, False]


@pytest.mark.parametrize(("pattern", "yes", "no"), [("a.*", ["a.b"], ["a", "a.b.c"]), ("a.>", ["a.b", "a.b.c"], ["a"]), ("*.b", ["x.b"], ["b", "x.c"]), ("a.b", ["a.b"], ["aXb"])])
def test_subjects(spark, pattern, yes, no):
    t = spark.createDataFrame([(s,) for s in yes + no], "s string")
    got = [r[0] for r in t.select(headers.matches_subject(F.col("s"), [pattern])).collect()]
    assert got == [True] * len(yes) + [False] * len(no)
