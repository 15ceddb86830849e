import bisect
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from streamchain.llm import bestfit
from streamchain.llm.queries import tokenizer_file

from . import data

PATH = tokenizer_file("byte_bpe_50k.json")


def _ids(texts):
    tokenizer = bestfit.load_tokenizer(PATH)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def _check(rows, got, capacity):
    """Every row's pieces are its ids, cut only where they must be, and windows hold no more than they can, without gaps. Gives the windows' fills."""
    want = defaultdict(int)
    for (d, *_), ids in zip(rows, _ids([r[1] for r in rows]), strict=True):
        head = len(ids) - (-(-len(ids) // capacity) - 1) * capacity
        for piece, end in enumerate(range(head, len(ids) + 1, capacity)):
            start = 0 if piece == 0 else end - capacity
            want[d, piece, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())] += 1
    windows = defaultdict(list)
    for r in got:
        want[tuple(r)[:5]] -= 1
        windows[r.sequence_id].append((r.offset, r.length))
    assert not any(want.values())
    fills = []
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        fills.append(at)
    assert max(fills, default=0) <= capacity
    return fills


@pytest.mark.parametrize("capacity", [2048, 16])
def test_hard_documents(spark, capacity):
    fills = _check(data.hard_rows(), bestfit.pack(data.hard_docs(spark), PATH, capacity).collect(), capacity)
    assert len(fills) <= 1.02 * -(-sum(fills) // capacity) + 1


def test_many_texts_of_one_length(spark):
    rows = [(k % 7, "one two three") for k in range(500)] + [(None, None)] * 40
    fills = _check(rows, bestfit.pack(data.plain_docs(spark, rows).repartition(5), PATH, 17).collect(), 17)
    assert len(fills) == 125  # four of four ids each, and one end id


def test_no_documents(spark):
    assert bestfit.pack(data.no_docs(spark), PATH).collect() == []


def test_stretches_encode_as_their_text():
    rnd = random.Random(5)
    letters = list("aAbZ.,'’sStTé́ß0 19<|>_-\n\tİΣ!# à") + ["<|endoftext|>", "'S", "'ll", "日", " ", "　", " ", "\u0085", " ", "  ", " \n", "\x1c", " ", " ", " "]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(4000)] + ["", "<|endoftext|>. a", "  ", " "]
    ids, at = bestfit.encoded(bestfit.load_tokenizer(PATH), pa.array(["x", *texts], pa.large_string()).slice(1), 0)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == _ids(texts)


def _decreasing(counts, capacity):
    """Windows of plain best fit over pieces from long to short."""
    gaps, n = [], 0
    for x in range(capacity, 0, -1):
        for _ in range(int(counts[x])):
            k = bisect.bisect_left(gaps, x)
            n += k == len(gaps)
            gap = (gaps.pop(k) if k < len(gaps) else capacity) - x
            if gap:
                bisect.insort(gaps, gap)
    return n


@pytest.mark.parametrize("name", ["any", "short", "middle", "skewed", "long", "few lengths", "one length", "none"])
def test_plans(name):
    rnd = random.Random(name)
    capacity = 512
    draw = {
        "any": lambda: rnd.randint(1, capacity), "short": lambda: rnd.randint(1, 30), "middle": lambda: rnd.randint(80, 220), "skewed": lambda: min(capacity, int(rnd.lognormvariate(4.5, 1)) + 1),
        "long": lambda: rnd.randint(230, capacity), "few lengths": lambda: rnd.choice((171, 172, 125, 257)), "one length": lambda: 100, "none": None,
    }[name]
    for n in (0,) if name == "none" else (1, 30, 1000, 9000):
        counts = np.bincount([draw() for _ in range(n)], minlength=capacity + 1)
        plan = bestfit.patterns(counts, capacity)
        used = np.zeros(capacity + 1, int)
        for pattern, times in plan:
            assert sum(pattern) <= capacity and times > 0
            for x in pattern:
                used[x] += times
        assert (used == counts).all()
        assert sum(times for _, times in plan) <= _decreasing(counts, capacity)
        assert len(plan) <= 3 * capacity  # however many pieces


def test_exact_complements_come_first():
    counts = np.bincount([9, 7, 4, 3, 2, 1], minlength=11)
    assert bestfit.patterns(counts, 10) == [((9, 1), 1), ((7, 3), 1), ((4, 2), 1)]
    held = bestfit.Lengths(np.bincount([3, 3, 2], minlength=11))
    assert held.exact(6) == (3, 3) and held.exact(8) == (3, 3, 2) and held.exact(9) == () and held.exact(4) == ()


def test_stretches_of_earlier_chunks_are_not_encoded_again():
    from .test_packing import Counting

    counting, known = Counting(PATH), bestfit.Known()
    column = pa.array(["some words, some more", "", "naïve ß\n x"], pa.large_string())
    bestfit.encoded(counting, column, 0, known)
    before = counting.seen
    ids, at = bestfit.encoded(counting, column, 0, known)
    plain, places = bestfit.encoded(counting.inner, column, 0)
    assert counting.seen == before and ids.tolist() == plain.tolist() and at.tolist() == places.tolist()
