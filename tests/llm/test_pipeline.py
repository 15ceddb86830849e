import random

from pyspark.sql import functions as F

import corpus_pipeline
from streamchain.llm import decontaminate, jaccard

from . import data
from .test_decontaminate import table
from .test_jaccard import brute, edited


def run_stages(spark, docs, folder, tmp_path):
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(docs)
    return kept


def test_stages_on_hard_documents(spark, tmp_path):
    table(spark, [(1, data.prose(4, 13)), (2, None)]).write.parquet(f"{tmp_path}/in/benchmark.parquet")
    first = data.hard_docs(spark)
    stages = run_stages(spark, first, f"{tmp_path}/in", tmp_path)
    for docs in stages[:-1]:
        assert docs.columns == list(corpus_pipeline.COLUMNS)
    ids = [sorted(str(r.doc_id) for r in docs.select("doc_id").collect()) for docs in stages[:-1]]
    assert {"3", "4", "6"}.isdisjoint(ids[0]) and ids[0].count("7") == 2
    assert ids[1].count("5") == 1 and {"7", "9", "11", "12", "19"}.isdisjoint(ids[1])
    assert {"18", "20"}.isdisjoint(ids[2]) and ids[3] == ids[2]
    texts = {r.doc_id: (r.text, r.n_chars) for r in stages[3].collect()}
    assert texts[17] == ("mail me: [EMAIL], or [PHONE]; [CARD] at [IP].", 45)
    packed = {r.doc_id for r in stages[4].select("doc_id").distinct().collect()}
    assert sorted(map(str, packed)) == sorted(set(ids[3]))


def test_run_keeps_clean_documents(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").distinct().collect()}
    groups = {r.doc_id: r.component_id for r in jaccard.join(spark, docs).collect()}
    hit = {r.doc_id for r in decontaminate.contamination(spark, docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect() if r.contaminated}
    assert got == {d for d, c in groups.items() if d == c and d not in hit}


def test_no_documents(spark, sf, tmp_path):
    for docs in run_stages(spark, data.no_docs(spark), sf, tmp_path):
        assert docs.count() == 0


def test_near_copies_share_four_fifths_of_their_five_word_shingles(spark):
    base, other = ([f"{c}{k}" for k in range(500)] for c in "ab")
    rows = [(1, base), (2, base + [f"c{k}" for k in range(95)]), (3, other), (4, other[:200] + [f"d{k}" for k in range(45)] + other[245:])]
    rows = [(d, " ".join(words)) for d, words in rows]
    rnd = random.Random(5)
    for family, size in enumerate((30, 60, 120)):
        words = data.prose(family, size).split()
        rows += [(10 + 20 * family + k, edited(rnd, words, rnd.randrange(7))) for k in range(15)]
    want = {d for d, _, c in brute(rows, 5, 80) if d == c}
    assert {1, 2, 3, 4} & want == {1, 3} and want < {d for d, _, c in brute(rows) if d == c}
    kept = corpus_pipeline.near_copies(spark, data.plain_docs(spark, rows), None)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_verdicts_stay_on_their_rows_where_ids_are_null_or_repeated(spark, tmp_path):
    passage, base, other = data.prose(4, 13), data.prose(50, 80), data.prose(51, 80)
    clean = data.prose(52, 40)
    table(spark, [(1, passage)]).write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, "x " + passage), (None, clean), (None, clean), (7, passage + " y"), (7, clean), (7, other), (8, passage), (9, None), (9, base)]
    kept = corpus_pipeline.benchmark_passages(spark, data.plain_docs(spark, rows), str(tmp_path))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(((d, t) for d, t in rows if passage not in (t or "")), key=str)

    rows = [(7, base + " tail"), (7, other), (3, base), (9, other + " tail"), (12, clean), (12, clean), (12, None), (12, None), (None, base), (None, base), (20, clean + " a"), (20, clean + " b"), (5, "one two"), (5, "three")]
    rows += [(30, data.prose(53, 60)), (30, data.prose(53, 60) + " end")]
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, data.plain_docs(spark, rows), None).collect()), key=str)
    either = [x for x in kept if x[0] == 30]
    assert len(either) == 1 and either[0] in rows
    assert [x for x in kept if x[0] != 30] == sorted([(3, base), (7, other), (12, clean), (12, None), (None, base), (None, base), (5, "one two"), (5, "three")], key=str)


def test_rows_that_share_a_key_are_told_apart(spark):
    docs = data.hard_docs(spark)
    rows = corpus_pipeline.keyed(docs, key=F.coalesce(F.length("text"), F.lit(0)).cast("long")).collect()
    assert sorted(str(r[:2]) for r in rows) == sorted(str(r[:2]) for r in data.hard_rows())
    of = {}
    for r in rows:
        of.setdefault(r.row_key, set()).add((r.doc_id, r.text))
    assert all(len(x) == 1 for x in of.values()) and len(of) == len({(r.doc_id, r.text) for r in rows})
