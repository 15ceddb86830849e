"""Tables of one kind of text alone, in fewer, as many and more blocks than rows."""

import pytest

from streamchain.llm import jaccard, substrings

from . import data
from .test_jaccard import brute as brute_groups
from .test_substrings import brute as brute_words

TABLES = {
    "all null": [(k, None) for k in range(4)],
    "null and empty": [(1, None), (2, ""), (None, " \n"), (None, None)],
    "all short": [(k, f"w{k} one") for k in range(5)],
    "all distinct": [(k, " ".join(f"d{k}x{i}" for i in range(40))) for k in range(6)],
    "all equal": [(k, data.prose(9, 50)) for k in range(6)],
    "one row": [(7, data.prose(8, 60))],
    "one id": [(3, data.prose(k % 2, 30)) for k in range(6)],
}


@pytest.mark.parametrize("blocks", [1, 9])
@pytest.mark.parametrize("name", TABLES)
def test_substrings(spark, name, blocks):
    rows = TABLES[name]
    assert sorted(map(tuple, substrings.deduplicate(data.plain_docs(spark, rows), blocks=blocks).collect()), key=str) == brute_words(rows)


@pytest.mark.parametrize("blocks", [1, 9])
@pytest.mark.parametrize("name", TABLES)
def test_jaccard(spark, name, blocks):
    rows = TABLES[name]
    assert sorted(map(tuple, jaccard.join(spark, data.plain_docs(spark, rows), blocks=blocks).collect()), key=str) == brute_groups(rows)


@pytest.mark.parametrize("name", TABLES)
def test_near_copies(spark, name):
    import corpus_pipeline

    rows = TABLES[name]
    kept = corpus_pipeline.near_copies(spark, data.plain_docs(spark, rows), "").collect()
    distinct = {"all null": 4, "null and empty": 4, "all short": 5, "all distinct": 6, "all equal": 1, "one row": 1, "one id": 2}
    assert len(kept) == distinct[name]
    assert {r.doc_id for r in kept} <= {d for d, _ in rows}
