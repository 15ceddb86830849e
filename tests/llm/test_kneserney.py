import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from streamchain.llm import kneserney as kn

from . import data


def brute(rows):
    """The model from its formulas over plain dicts of words."""
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    toks = [(d, [w for w in data.ascii_lower(t).split()] + ["</s>"]) for d, t in rows]
    pairs, count = Counter(), Counter()
    for d, t in toks:
        if not held(d):
            count.update(t)
            pairs.update(zip(["<s>", *t], t))
    total, types = sum(count.values()), len(count)
    kinds = Counter(w for _, w in pairs)
    by = defaultdict(Counter)
    for (u, w), c in pairs.items():
        by[u][w] = c
    n = lambda c: [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
    d1, d0 = kn.discounts(n(pairs)), kn.discounts(n(kinds))
    less = lambda c, d: max(c - (0, *d)[min(c, 3)], 0)
    spare = sum(less_ for less_ in (d0[min(c, 3) - 1] for c in kinds.values()))

    def low(w):
        if not kinds:
            return 1 / (types + 1)
        return less(kinds[w], d0) / len(pairs) + spare / len(pairs) / (types + 1)

    def p(u, w):
        c = by.get(u)
        if not c:
            return low(w)
        return (less(c[w], d1) + sum(d1[min(x, 3) - 1] for x in c.values()) * low(w)) / sum(c.values())

    out = []
    for d, t in toks:
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (types + 1))) for w in t)
        out.append((d, held(d), len(t), sum(count[w] > 0 for w in t), total, base, sum(math.log10(p(u, w)) for u, w in zip(["<s>", *t], t))))
    return out, p, count


def _check(got, want):
    key = lambda r: (str(r[0]), r[2], r[5])
    got, want = sorted((tuple(r)[:7] for r in got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [x for g in got for x in g[5:]] == pytest.approx([x for w in want for x in w[5:]], rel=1e-9)


def test_against_the_formulas(spark):
    rows = [(r[0], r[1]) for r in data.hard_rows()] + [(100 + k, data.prose(k, 3 * k)) for k in range(60)]
    want, p, count = brute(rows)
    _check(kn.train_and_score(spark, data.plain_docs(spark, rows)).collect(), want)
    assert sum(p("the", w) for w in count) + p("the", "never seen") == pytest.approx(1)
    _check(kn.train_and_score(spark, data.hard_docs(spark)).collect(), brute([(r[0], r[1]) for r in data.hard_rows()])[0])


def test_neither_shards_nor_hot_contexts_matter(spark, tmp_path):
    from pyspark.sql import functions as F

    docs = data.plain_docs(spark, [(k, data.prose(k, 40)) for k in range(20)]).withColumn("held_out", F.lit(False))
    scores = []
    some = kn.tokens(kn.texts(kn.pa.array([data.prose(1, 9)])))[0]
    for n, hot in ((1, [kn.BEGIN]), (7, None), (5, [kn.BEGIN, *some])):
        model = kn.train(spark, docs, f"file://{tmp_path}/m{n}", n, hot if hot is None else np.unique(np.array(hot, np.uint64)))
        assert model.hot_sums[model.hot == kn.BEGIN].tolist()[0][0] == 20
        scores.append([r.score for r in kn.score(docs, model).orderBy("doc_id").collect()])
    assert scores[0] == pytest.approx(scores[1]) and scores[0] == pytest.approx(scores[2])


def _docs(spark):
    from pyspark.sql import functions as F

    return data.plain_docs(spark, [(k, data.prose(k, 40)) for k in range(20)]).withColumn("held_out", F.lit(False))


def test_a_lost_file_is_an_error(spark, tmp_path):
    from pyspark.errors import PythonException

    docs = _docs(spark)
    model = kn.train(spark, docs, f"file://{tmp_path}/m", 2)
    assert {p.name for p in (tmp_path / "m").iterdir()} == {f"{kind}-{k}" for kind in ("bigrams", "contexts", "tokens") for k in (0, 1)}
    whole = (tmp_path / "m/bigrams-0").read_bytes()
    (tmp_path / "m/bigrams-0").write_bytes(whole[:16] + whole[24:])
    with pytest.raises(PythonException, match="not whole"):
        kn.score(docs, model).collect()
    (tmp_path / "m/bigrams-0").write_bytes(whole)
    (tmp_path / "m/bigrams-1").unlink()
    with pytest.raises(PythonException):
        kn.score(docs, model).collect()


def test_files_are_few_whatever_the_shards_and_are_opened_once(spark, tmp_path, monkeypatch):
    docs = _docs(spark)
    model = kn.train(spark, docs, f"file://{tmp_path}/m", 50, files=3)
    assert {p.name for p in (tmp_path / "m").iterdir()} == {f"{kind}-{k}" for kind in ("bigrams", "contexts", "tokens") for k in range(3)}
    opened = []

    class Counted(kn.Stored):
        def __init__(self, folder, name):
            opened.append(name)
            super().__init__(folder, name)

    monkeypatch.setattr(kn, "Stored", Counted)
    scorer = kn.Scorer(model)
    for k in range(6):
        token, before, _ = kn.tokens(kn.texts(kn.pa.array([data.prose(k, 40)])))
        scorer.log10(token, before)
    assert len(opened) == len(set(opened)) <= 9
    one = kn.train(spark, docs, f"file://{tmp_path}/one", 1)
    assert [r.score for r in kn.score(docs, model).orderBy("doc_id").collect()] == pytest.approx([r.score for r in kn.score(docs, one).orderBy("doc_id").collect()])


def test_from_a_folder_that_is_not_mounted_sections_are_read_and_few_kept(spark, tmp_path, monkeypatch):
    model = kn.train(spark, _docs(spark), f"file://{tmp_path}/m", 9, files=4)
    token, before, _ = kn.tokens(kn.texts(kn.pa.array([data.prose(3, 40)])))
    want = kn.Scorer(model).log10(token, before)[0].tolist()
    init = kn.Folder.__init__

    def far(self, uri):
        init(self, uri)
        self.mounted = False

    monkeypatch.setattr(kn.Folder, "__init__", far)
    scorer = kn.Scorer(model, kept=1)
    assert scorer.log10(token, before)[0].tolist() == want and len(scorer.kept) == 1
    written = kn.Written(kn.Folder(f"file://{tmp_path}"), "w")
    written.add(7, kn.packed(np.array([5], np.uint64), np.array([6])))
    written.close()
    assert kn.Sorted(kn.Stored(kn.Folder(f"file://{tmp_path}"), "w").section(7)).find(np.array([5], np.uint64))[0].tolist() == [6]


def test_hot_contexts_follow_the_shards():
    assert kn.hot_share(10) == kn.hot_share(1000) == kn.HOT_SHARE
    assert kn.hot_share(50_000) == pytest.approx(kn.HOT_SHARDS / 50_000) and kn.hot_share(10**9) == 1 / kn.MOST_HOT


def test_counts_beyond_32_bits():
    find = lambda *a: [v.tolist() for v in kn.Sorted(np.frombuffer(kn.packed(*a[:-1]), np.uint8)).find(a[-1])]
    assert find(np.array([3, 9], np.uint64), np.array([1, 1 << 40]), np.array([5, 6]), np.array([9, 4, 3], np.uint64)) == [[1 << 40, 0, 1], [6, 0, 5]]
    assert find(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.array([9], np.uint64)) == [[0]]


def test_nothing_to_learn(spark):
    assert kn.train_and_score(spark, data.no_docs(spark)).collect() == []
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0][:2]
    got = kn.train_and_score(spark, data.plain_docs(spark, [(k, "a b") for k in held])).collect()
    assert [(r.train_tokens, r.n_known, r.score) for r in got] == [(0, 0, 0.0)] * 2


def test_beats_the_base_on_held_out_texts(spark, sf):
    got = kn.train_and_score(spark, spark.read.parquet(f"{sf}/documents.parquet")).filter("held_out").collect()
    assert got and sum(r.score for r in got) > sum(r.base_score for r in got)
