import random
import re
from collections import Counter

import pytest

from streamchain.llm import phrases

from . import data


def brute(rows, least, most=5, top=2000):
    """rows: (text, lang)."""
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", data.ascii_lower(text)):
            w = [x for x in re.split(rb"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    held = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= least}
    inside = {(lang, w[i:j]) for (lang, w), c in held.items() for i in range(len(w)) for j in range(i + 2, len(w) + 1) if j - i < len(w) and f[lang, w[i:j]] <= c}
    out = {}
    for (lang, w), a in held.items():
        if (lang, w) not in inside:
            score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, b" ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    return sorted((lang, rank, r[2].decode("utf-8", "surrogatepass"), *r[3:]) for lang, found in out.items() for rank, r in enumerate(sorted(found)[:top], 1))


def got(docs, **options):
    out = phrases.collocations(docs, **options)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in out.collect())


def docs_of(spark, rows):
    return spark.createDataFrame([(k, t, lang, None, None) for k, (t, lang) in enumerate(rows)], data.SCHEMA).repartition(3)


def test_hard_documents(spark):
    rows = [(r[1], r[2]) for r in data.hard_rows()]
    assert got(data.hard_docs(spark), least=3, blocks=2) == brute(rows, 3)


@pytest.mark.parametrize("hot", [phrases.HOT, 5])
def test_any_texts(spark, monkeypatch, hot):
    """With pairs dealt by the next word too, and without."""
    monkeypatch.setattr(phrases, "HOT", hot)
    rnd = random.Random(hot)
    words = ["a", "b", "C", "dé", "e\x1c", "F,", "g.", "h\n", "ı", "日", "x\ty", "Z!?", "q" * 50]
    rows = [(" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))), rnd.choice(("en", "de", None, "und"))) for _ in range(80)]
    rows += [("one two three four five six, One two", "en")] * 40 + [(None, "en"), ("", None), (" ., ", "de")]
    least, top, blocks = (8, 2000, 5) if hot == 5 else (30, 7, 2)
    assert got(docs_of(spark, rows), least=least, top=top, blocks=blocks) == brute(rows, least, top=top)


def test_longest_phrases_and_ties(spark):
    rows = [("a b c d e f g", "x")] * 5 + [("p q", "x"), ("r s", "x")] * 5 + [("a b", "x")] * 2
    assert got(docs_of(spark, rows), least=5, most=3, top=4) == brute(rows, 5, most=3, top=4)
    assert got(docs_of(spark, rows), least=5, most=2) == brute(rows, 5, most=2)


def test_no_documents(spark):
    assert got(data.no_docs(spark)) == []
    assert got(docs_of(spark, [(None, None), ("", "en"), (" . ", "en")]), blocks=1) == []


def test_exact_beyond_64_bits(spark):
    """A text that occurs so often that products pass 64 bits."""
    many = 3_000_000_000
    held = phrases.Block
    rows = [("u v", "x"), ("w", "x")]

    class Heavy(held):
        def __init__(self, docs, shards):
            super().__init__(docs, shards)
            self.weight = self.weight * many

    phrases_block, phrases.Block = phrases.Block, Heavy
    try:
        found = got(docs_of(spark, rows), blocks=1)
    finally:
        phrases.Block = phrases_block
    assert found == [("x", 1, "u v", many, many, many, 3 * many, 3000)]
