import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from streamchain.llm import periods

from . import data


def brute_runs(x, least=12):
    n, out = len(x), []
    for p in range(1, n // 2 + 1):
        s = 0
        while s + p < n:
            e = s
            while e + p < n and x[e] == x[e + p]:
                e += 1
            y = x[s : e + p]
            if e - s >= p and len(y) >= least and not any(all(y[k] == y[k + q] for k in range(len(y) - q)) for q in range(1, p)):
                out.append((s, len(y), p))
            s = max(e, s + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(rows, plant=True):
    out = []
    for d, t in rows:
        w = data.words_ws(t)
        n = len(w)
        if plant and d is not None and n and (h := zlib.crc32(str(d).encode())) % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute_runs(w)
        gone = set().union(*(range(s + q, s + m) for s, m, q in found))
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        out.append((d, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=str)


def got(docs, **options):
    return sorted((tuple(r) for r in periods.detect(docs, **options).collect()), key=str)


def _numbers(x):
    return np.unique(np.array(x, np.int64), return_inverse=True)[1]


def test_hard_documents(spark):
    # the longest texts are compared on their own below: plain code takes the square of their words
    rows = [(r[0], r[1]) for r in data.hard_rows() if len(r[1] or "") < 5000]
    assert got(data.plain_docs(spark, rows), plant=True) == brute(rows)
    ids = [k for k in range(-50, 400) if zlib.crc32(str(k).encode()) % 10 == 0]
    rows = [(k, data.prose(k, 3 * i + 1)) for i, k in enumerate(ids)] + [(k, " ".join(data.prose(k, k % 7 + 1).split() * (k % 9))) for k in range(60)]
    assert got(data.plain_docs(spark, rows), plant=True) == brute(rows)
    assert got(data.plain_docs(spark, rows)) == brute(rows, plant=False)
    assert len(got(data.hard_docs(spark), plant=True)) == len(data.hard_rows())


def test_long_and_repeated_texts(spark):
    rows = [(1, "a " * 50_000), (2, data.prose(1, 30_000)), (3, " ".join(data.prose(2, 2000).split() * 9)), (4, "x" * 100_000)]
    found = {r.doc_id: r for r in periods.detect(data.plain_docs(spark, rows)).collect()}
    assert found[1][1:6] == (1, 0, 50_000, 1, 50_000_000)
    assert (found[3].start, found[3].length, found[3].period) == (0, 18_000, 2000)
    assert found[4].n_runs == 0 and found[4].start is None


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_runs_of_any_sequence(letters):
    rnd = random.Random(letters)
    for _ in range(1500):
        x = [rnd.randrange(letters) for _ in range(rnd.randint(0, 40))]
        if rnd.random() < 0.5:
            x = x[:9] + x[9:14] * rnd.randint(0, 6) + x[14:20]
        for least in (2, 12):
            assert periods.runs(_numbers(x), least) == brute_runs(x, least)


def test_lyndon_array():
    rnd = random.Random(4)
    for _ in range(1500):
        x = [rnd.randrange(3) for _ in range(rnd.randint(1, 30))] + [-1]
        smaller, match = periods.lyndon(x)
        for i in range(len(x) - 1):
            j = next(j for j in range(i + 1, len(x)) if x[j:] < x[i:])
            assert smaller[i] == j
            if j < len(x) - 1:
                assert x[i : i + match[i]] == x[j : j + match[i]] and x[i + match[i]] != x[j + match[i]]


def test_time_grows_with_the_words():
    """Sequences whose suffixes match far: plain comparing would take the square of their length."""
    fib = [0], [0, 1]
    while len(fib[1]) < 60_000:
        fib = fib[1], fib[1] + fib[0]
    hard = [[0] * 60_000, [0] * 30_000 + [1, 2] + [0] * 30_000 + [1, 1], fib[1], [0, 1] * 30_000, list(range(20_000)) * 3, [bin(k).count("1") % 2 for k in range(60_000)]]
    began = time.process_time()
    for x in hard:
        periods.runs(np.array(x))
    assert time.process_time() - began < 15  # 3 on a usual core


def test_no_documents(spark):
    assert got(data.no_docs(spark)) == []
