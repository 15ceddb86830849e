import hashlib
import random

import pytest

from streamchain.llm import substrings

from . import data


def brute(rows, window=13):
    least = {}
    words = [(d, data.words_ws(t)) for d, t in rows]
    rank = lambda d: float("inf") if d is None else d
    for d, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            least[key] = min(least.get(key, rank(d)), rank(d))
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < rank(d):
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def got(docs, **options):
    return sorted((tuple(r) for r in substrings.deduplicate(docs, **options).collect()), key=str)


def test_hard_documents(spark):
    for blocks in (1, 5):
        assert got(data.hard_docs(spark), blocks=blocks) == brute([(r[0], r[1]) for r in data.hard_rows()])


@pytest.mark.parametrize("window", [13, 4, 7])
def test_shared_passages(spark, window):
    rnd = random.Random(window)
    passages = [data.prose(100 + k, rnd.randint(window - 2, 3 * window)) for k in range(6)]
    rows = [(k * 7 % 61, " ".join(rnd.choice(passages) if rnd.random() < 0.4 else rnd.choice(data.WORDS) for _ in range(rnd.randint(0, 60)))) for k in range(61)]
    assert got(data.plain_docs(spark, rows), window=window, blocks=4) == brute(rows, window)


def test_covers():
    assert substrings.difference_cover(7) == (0, 1, 3)
    for period in (1, 2, 4, 6, 8, 10):
        cover = substrings.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_no_documents(spark):
    assert got(data.no_docs(spark)) == []
