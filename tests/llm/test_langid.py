import zlib

from streamchain.llm import langid

from . import data


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in got)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert sum(r.rejected for r in got) <= 0.001 * len(got) and all(0 <= r.score <= 1 for r in got)


def test_hard_documents(spark):
    got = langid.identify(spark, data.hard_docs(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in data.hard_rows())
    for r in got:
        assert (r.lang_pred == "und") == (r.doc_id in (3, 4, 6) or (r.doc_id is None and r.score == 0))
        assert r.lang_pred in ("en", "de", "und") and (r.lang_pred != "und" or r.rejected)


def test_nothing_to_learn(spark):
    assert langid.identify(spark, data.no_docs(spark)).collect() == []
    got = langid.identify(spark, data.plain_docs(spark, [(1, "some text"), (2, None)])).collect()
    assert {r.lang_pred for r in got} == {"und"}


def test_rejects_what_is_far(spark):
    import random

    rows = [(k, data.prose(k, 80, ["the", "of", "and", "river", "stone"]), "en", None, None) for k in range(40)]
    model = langid.fit(spark, spark.createDataFrame(rows, data.SCHEMA))
    rnd = random.Random(1)
    noise = " ".join("".join(rnd.choice("qxzjvkw") for _ in range(6)) for _ in range(90))
    got = langid.predict_rows(spark.createDataFrame([(1, noise, "en", None, None), (2, rows[0][1], "en", None, None), (3, "12 34", None, None, None)], data.SCHEMA), model)
    assert {r.doc_id: r.rejected for r in got.collect()} == {1: True, 2: False, 3: True}


def test_short_noise_is_far_and_short_texts_are_not(spark):
    import random

    rnd = random.Random(2)
    words = "the of and river stone cloud wander quickly amber seventeen some where when night little morning".split()
    rows = [(k, data.prose(k, 80, words), "en", None, None) for k in range(60)]
    model = langid.fit(spark, spark.createDataFrame(rows, data.SCHEMA))
    short = [(k, data.prose(500 + k, 4, words), None, None, None) for k in range(40)]
    noise = [(100 + k, " ".join("".join(rnd.choice("qxzjvkw") for _ in range(7)) for _ in range(4)), None, None, None) for k in range(40)]
    got = {r.doc_id: r.rejected for r in langid.predict_rows(spark.createDataFrame(short + noise, data.SCHEMA), model).collect()}
    assert sum(got[k] for k in range(40)) <= 1 and all(got[k] for k in range(100, 140))


def test_every_language_is_learned(spark):
    rows = [(k, " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + j)}" * 2 for j in range(9)), f"l{k // 2}", None, None) for k in range(1000)]
    model = langid.fit(spark, spark.createDataFrame(rows, data.SCHEMA), sample=500, least=2, clusters=1)
    assert model.languages == sorted({f"l{k}" for k in range(500)})


def plain_grams(text):
    """Letter n-grams of a text, each word between two marks."""
    import unicodedata

    marked = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in " " + text.lower() + " ")
    words = [w for w in marked.split(" ") if w]
    line = " " + " ".join(words) + " " if words else ""
    out = []
    for size in (1, 2, 3):
        for i in range(len(line) - size + 1):
            g = line[i : i + size]
            if (size == 3 and g[1] != " ") or (size < 3 and g.strip()):
                out.append(g)
    return out


def test_against_plain_vectors(spark):
    """Counts, weights, clusters and cosines over dicts of hashed n-grams, for a language of one cluster."""
    import math
    from collections import Counter

    def slot(gram):
        h = len(gram)
        for c in gram:
            h = ((h ^ (0 if c == " " else ord(c))) * 0x9E3779B1) & 0xFFFFFFFF
            h ^= h >> 15
        return h >> 20

    words = {"aa": "river stone cloud amber night".split(), "bb": "fluss stein wolke über nacht".split(), "cc": "río piedra nube ámbar noche".split()}
    rows = [(k, data.prose(k, 20 + k % 30, words[lang]) + (", 3x!" if k % 4 else "."), lang, None, None) for k in range(60) for lang in [sorted(words)[k % 3]]]
    model = langid.fit(spark, spark.createDataFrame(rows, data.SCHEMA), clusters=1)
    asked = rows + [(100, "stone, nube", None, None, None), (101, "12 ?", None, None, None), (102, "ß水É", None, None, None)]
    got = {r.doc_id: r for r in langid.predict_rows(spark.createDataFrame(asked, data.SCHEMA), model).collect()}

    vectors = {d: Counter(map(slot, plain_grams(t))) for d, t, *_ in asked}
    known = {d: lang for d, _, lang, *_ in rows}
    df = Counter(s for d in known for s in vectors[d])
    idf = lambda s: math.log((1 + len(known)) / (1 + df[s])) + 1

    def unit(v):
        length = math.sqrt(sum(x * x for x in v.values()))
        return {s: x / length for s, x in v.items()} if length else {}

    weighed = {d: unit({s: math.log1p(c) * idf(s) for s, c in v.items()}) for d, v in vectors.items()}
    centre = {}
    for lang in words:
        total = Counter()
        for d in known:
            if known[d] == lang:
                total.update(weighed[d])
        centre[lang] = unit(total)
    cosine = lambda a, b: sum(x * b.get(s, 0) for s, x in a.items())
    for d, t, *_ in asked:
        scores = {lang: cosine(weighed[d], centre[lang]) for lang in words}
        best = max(scores, key=scores.get)
        if vectors[d]:
            assert got[d].lang_pred == best and abs(got[d].score - scores[best]) < 1e-4
        else:
            assert got[d].lang_pred == "und" and got[d].score == 0 and got[d].rejected
    floors = {lang: sorted(got[d].score for d in known if known[d] == lang)[0] for lang in words}
    for d in known:
        assert not got[d].rejected or got[d].score < floors[known[d]]


def test_ids_and_repeated_rows_take_no_language_away(spark):
    english, german = "the of and river stone where night little".split(), "der die und fluss stein wo nacht kleine".split()
    rows = [(k, data.prose(k, 60, english), "en", None, None) for k in range(20)] + [(k, data.prose(100 + k, 60, german), "de", None, None) for k in range(20)]
    rows += [(None, data.prose(200 + k, 60, ["ilha", "noite", "pedra", "pequena", "quando"]), "pt", None, None) for k in range(20)]
    rows += [(5, data.prose(300, 60, ["yksi", "kaksi", "kolme"]), "fi", None, None)] * 3000 + [(6, data.prose(301, 60, ["yksi", "kaksi", "kolme"]), "fi", None, None)]
    model = langid.fit(spark, spark.createDataFrame(rows, data.SCHEMA))
    assert model.languages == ["de", "en", "fi", "pt"]
    asked = [(1, data.prose(900, 30, english), None, None, None), (2, data.prose(901, 30, german), None, None, None), (3, "pedra e noite quando ilha pequena", None, None, None)]
    assert {r.doc_id: r.lang_pred for r in langid.predict_rows(spark.createDataFrame(asked, data.SCHEMA), model).collect()} == {1: "en", 2: "de", 3: "pt"}


def test_a_sample_is_weighed_in_little_memory(spark):
    """Wide temporaries of the whole sample (some 300 MB) are never held: of 2400 documents the driver keeps unit rows of four bytes a dimension alone."""
    import tracemalloc

    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + k * 7 % 26)}" for k in range(400)]
    rows = [(k, data.prose(k, 40, words[k % 4 * 100 : k % 4 * 100 + 100]), f"l{k % 4}", None, None) for k in range(2400)]
    docs = spark.createDataFrame(rows, data.SCHEMA)
    tracemalloc.start()
    model = langid.fit(spark, docs)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert model.languages == ["l0", "l1", "l2", "l3"] and most < 150e6
