import random

import pytest
from tokenizers import Tokenizer, models, normalizers

from streamchain.llm import tokencount
from streamchain.llm.queries import tokenizer_file

from . import data

PATH = tokenizer_file("piece_bpe_32k.model")


def exact(vocabulary, byte_fallback=True):
    t = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_hard_documents(spark):
    count = exact(tokencount.load_vocabulary(PATH))
    got = sorted(((r.doc_id, r.n_tokens) for r in tokencount.count_tokens(data.hard_docs(spark), PATH).collect()), key=str)
    assert got == sorted(((d, count(t or "")) for d, t, *_ in data.hard_rows()), key=str)
    assert tokencount.count_tokens(data.no_docs(spark), PATH).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_ties_and_unknown_characters(seed):
    rnd = random.Random(seed)
    pieces = ["<unk>", "▁", "a", "b", "ab", "ba", "aab", "▁a", "▁▁", "abab", "c▁a", "bb"]
    vocabulary = [(p, float(rnd.choice((-1, -2, -3)))) for p in pieces[: rnd.randint(6, len(pieces))]]
    count, counter = exact(vocabulary, False), tokencount.Counter(vocabulary)
    for _ in range(400):
        text = "".join(rnd.choice("aabbc x\n") for _ in range(rnd.randint(0, 25)))
        assert counter.of(text)[0] == count(text), repr(text)
