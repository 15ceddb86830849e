import random

import pytest

from streamchain.llm import jaccard
from streamchain.llm.components import components

from . import data


def shingles(text, size=4):
    w = data.ascii_lower(text).split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size=4, percent=85):
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), None if d is None else least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(spark, docs, **options):
    return sorted((tuple(r) for r in jaccard.join(spark, docs, **options).collect()), key=str)


def test_hard_documents(spark):
    assert got(spark, data.hard_docs(spark), blocks=3) == brute([(r[0], r[1]) for r in data.hard_rows()])


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        k = rnd.randrange(len(words))
        rnd.choice((lambda: words.__setitem__(k, f"w{rnd.randrange(9)}"), lambda: words.pop(k), lambda: words.insert(k, "new")))()
    return " ".join(words)


@pytest.mark.parametrize("linear", [jaccard.LINEAR, 0])
def test_families_of_near_copies(spark, monkeypatch, linear):
    """However entries are divided: hardly, and wherever it is worth its rows."""
    monkeypatch.setattr(jaccard, "LINEAR", linear)
    if not linear:
        monkeypatch.setattr(jaccard, "FEW", 1)
    rnd = random.Random(linear)
    rows = []
    for family in range(5 if linear else 3):
        base = data.prose(family, rnd.choice((5, 30, 50, 70))).split()
        common = data.prose(77, 25).split()
        for k in range(rnd.choice((2, 14, 22))):
            rows.append(edited(rnd, base + common * (family % 2), rnd.randrange(6)))
    rows += ["a b c", "A B C", "a b c d", "x"] * 2
    rows = list(zip(rnd.sample(range(500), len(rows)), rows))
    assert got(spark, data.plain_docs(spark, rows), blocks=4) == brute(rows)
    if linear:
        assert got(spark, data.plain_docs(spark, rows), blocks=1, size=2, percent=60) == brute(rows, 2, 60)


def test_texts_of_shared_phrases(spark, monkeypatch):
    """Entries that grow with the table while hardly anything links: pairs that are compared grow with the documents, not their square."""
    compared = []
    similar = jaccard._similar
    monkeypatch.setattr(jaccard, "_similar", lambda pairs, *rest: compared.append(pairs.count()) or similar(pairs, *rest))
    rnd = random.Random(3)
    phrases = [" ".join(f"p{k}w{i}" for i in range(6)) for k in range(60)]
    rows = [(k, " ".join(rnd.choice(phrases) for _ in range(12))) for k in range(800)]
    rows += [(1000 + k, rows[k][1] + " and a tail") for k in range(0, 800, 40)]
    assert got(spark, data.plain_docs(spark, rows)) == brute(rows)
    assert sum(compared) < 2 * len(rows)  # of 300,000 pairs that share a phrase


def test_no_documents(spark):
    assert got(spark, data.no_docs(spark)) == []


def test_components(spark):
    path = [(k, k + 1) for k in range(60)] + [(100, 103), (103, 101), (5, 5), (None, 7), (200, 201), (201, 200)]
    out = {r.node: r.component for r in components(spark, spark.createDataFrame(path, "a long, b long")).collect()}
    assert out == dict.fromkeys(range(61), 0) | {100: 100, 101: 100, 103: 100, 200: 200, 201: 200}
    assert components(spark, spark.createDataFrame([], "a long, b long")).collect() == []
