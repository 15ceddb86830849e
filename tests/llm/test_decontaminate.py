import hashlib
import random
import re

import pytest

from streamchain.llm import decontaminate

from . import data


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", data.ascii_lower(text))


def brute(rows, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(size, len(w))
        if item is not None and m:
            for i in range(len(w) - m + 1):
                windows.setdefault(tuple(w[i : i + m]), set()).add(str(item))
    lengths, out = {len(k) for k in windows}, []
    for d, text in rows:
        w = words(text)
        hit, found = set(), set()
        for m in lengths:
            for i in range(len(w) - m + 1):
                if own := windows.get(tuple(w[i : i + m])):
                    hit.update(range(i, i + m))
                    found |= own
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def table(spark, items):
    return spark.createDataFrame([(i, t, -1, "x") for i, t in items], "item_id long, text string, doc_id int, n_words string")


def got(spark, docs, items, **options):
    return sorted((tuple(r) for r in decontaminate.contamination(spark, docs, table(spark, items), **options).collect()), key=str)


ITEMS = [(1, data.prose(2, 25)), (2, "one two"), (10, "seventeen amber"), (3, None), (4, ""), (None, "one"), (5, data.prose(4, 13)), (5, data.prose(4, 13)), (6, "Nd Nd Nd"), (7, "a" * 100_000)]


@pytest.mark.parametrize("most_bytes", [4 << 20, 60_000])
def test_hard_documents(spark, most_bytes):
    want = brute([(r[0], r[1]) for r in data.hard_rows()], ITEMS)
    assert got(spark, data.hard_docs(spark), ITEMS, most_bytes=most_bytes) == want


def test_random_passages(spark):
    rnd = random.Random(9)
    few = ["a", "b", "c", "D."]
    items = [(k, data.prose(k, rnd.randint(1, 14), few)) for k in range(40)]
    rows = [(k, data.prose(1000 + k, rnd.randint(0, 80), few)) for k in range(80)]
    for size, most in ((10, 1 << 20), (5, 300), (2, 1 << 20), (2, 300), (1, 1 << 20), (1, 300)):  # 300 bytes: some nine parts
        assert got(spark, data.plain_docs(spark, rows), items, size=size, most_bytes=most) == brute(rows, items, size), (size, most)


def test_long_items_are_searched_in_pieces(spark):
    few = ["a", "b", "c", "D.", "e e"]
    items = [(1, data.prose(1, 3000, few)), (2, data.prose(2, 9, few)), (3, "a b"), (4, None), (1, data.prose(1, 3000, few))]
    rows = [(k, data.prose(50 + k, 120, few)) for k in range(20)] + [(100, " ".join(items[0][1].split()[1490:1530])), (100, None), (None, "x a b y"), (None, "x a b y"), (7, "")]
    assert got(spark, data.plain_docs(spark, rows), items, most_bytes=3000) == brute(rows, items)


def test_a_bucket_holds_the_windows_that_its_block_ends():
    import numpy as np
    import pyarrow as pa

    for t in decontaminate.build(pa.array([data.prose(k, 40, ["a", "b", "c"]) for k in range(6)], pa.large_string()), 10):
        first, words = decontaminate.split(pa.array([t.text.decode()], pa.large_string()))
        block = decontaminate._blocks(decontaminate.word_hashes(words), t.size)
        for k, (a, b) in enumerate(zip(t.buckets[:-1], t.buckets[1:], strict=True)):
            assert (block[t.places[a:b] + t.size - 1] == t.blocks[k]).all() and (b > a) == (t.shifts[k] == 0)
            assert (np.diff(t.hashes[a:b].astype(object)) >= 0).all()


def test_tables_of_a_full_load_are_small():
    import pickle

    import pyarrow as pa

    tables = decontaminate.build(pa.array([data.prose(k, 1000, [f"w{i}" for i in range(5000)]) for k in range(700)], pa.large_string()), 10)
    assert len(pickle.dumps(tables)) < 60 << 20  # 4 MB of text


def test_empty_tables(spark):
    assert got(spark, data.no_docs(spark), ITEMS) == []
    assert not any(r[5] for r in got(spark, data.hard_docs(spark), []))
