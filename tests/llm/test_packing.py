import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from streamchain.llm import packing
from streamchain.llm.queries import tokenizer_file

from . import data

PATH = tokenizer_file("word_bpe_49k.json")


def _ids(texts):
    tokenizer = packing.load_tokenizer(PATH)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def _check(rows, got, capacity):
    left = defaultdict(list)
    for (d, t, *_), ids in zip(rows, _ids([r[1] for r in rows]), strict=True):
        left[d, len(ids)].append(ids)
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.doc_tokens].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == left.keys()
    for key, own in pieces.items():
        assert sum(r.length for r in own) == sum(map(len, left[key]))
        spans = sorted((r.start, r.length) for r in own)
        assert spans[0][0] == 0
        for r in own:
            assert any(zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for ids in left[key])
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return [sum(n for _, n in w) for w in windows.values()]


@pytest.mark.parametrize("capacity", [2048, 16])
def test_hard_documents(spark, capacity):
    fills = _check(data.hard_rows(), packing.pack(data.hard_docs(spark), PATH, capacity).collect(), capacity)
    assert sum(f < capacity for f in fills) <= 3  # one a partition


def test_few_open_windows(spark):
    rows = [(k, data.prose(k, 5 + k % 40)) for k in range(300)]
    fills = _check(rows, packing.pack(data.plain_docs(spark, rows).coalesce(1), PATH, 64, most_open=3).collect(), 64)
    assert sum(f < 64 for f in fills) <= 1


def test_no_documents(spark):
    assert packing.pack(data.no_docs(spark), PATH).collect() == []


def test_words_encode_as_their_text():
    import random

    import pyarrow as pa

    rnd = random.Random(5)
    letters = list("aAbZ.,'’sStTé́ß0 19<|>_-\n\tİΣ!#") + ["<|endoftext|>", "'S", "日"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(3000)] + ["", "<|ENDOFTEXT|>.", "<|endoftext|>,."]
    ids, at = packing.encoded(packing.load_tokenizer(PATH), pa.array(texts, pa.large_string()), 1)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == _ids(texts)


def test_level_of_least_squares():
    p = packing.Packer(10, 100, 0)
    for k, size in enumerate((4, 4, 6)):
        p.add(k, np.arange(size))
    # 4: new. 4: beside the first (levels 8) rather than two at 4. 6: new, since no level takes it.
    assert [int(x) for x in np.flatnonzero(p.level)] == [6, 8]
    p.add(3, np.arange(2))
    assert [int(x) for x in np.flatnonzero(p.level)] == [6] and len(p.rows) == 3  # 8 + 2 is full


class Counting:
    """A tokenizer that tells how many texts it was given."""

    def __init__(self, path):
        self.inner, self.seen = packing.load_tokenizer(path), 0

    def encode_batch_fast(self, texts, **more):
        self.seen += len(texts)
        return self.inner.encode_batch_fast(texts, **more)


def test_words_of_earlier_chunks_are_not_encoded_again():
    first, second = (pa.array(t, pa.large_string()) for t in (["some words, some more", "", "naïve ß"], ["more some words", "new <|endoftext|> ß"]))
    counting, known = Counting(PATH), packing.Known()
    packing.encoded(counting, first, 1, known)
    before = counting.seen
    ids, at = packing.encoded(counting, second, 1, known)
    assert counting.seen - before == 2  # of the second chunk, only these are new: new, <|endoftext|>
    plain, places = packing.encoded(counting.inner, second, 1)
    assert ids.tolist() == plain.tolist() and at.tolist() == places.tolist()


def test_known_words_are_bounded_and_change_nothing():
    tokenizer = packing.load_tokenizer(PATH)
    for most in (0, 60, 400, 1 << 20):
        known = packing.Known(most)
        for k in range(12):
            column = pa.array([f"word{k} word{k + 1}, shared {k}.{k} {'x' * k}", None, ""][: 1 + k % 3], pa.large_string()).fill_null("")
            got, plain = packing.encoded(tokenizer, column, 1, known), packing.encoded(tokenizer, column, 1)
            assert all(a.tolist() == b.tolist() for a, b in zip(got, plain, strict=True))
            assert known.units.nbytes + known.flat.nbytes + known.sizes.nbytes <= most + 400


def test_another_run_begins_anew():
    assert packing.known_to_worker("a") is packing.known_to_worker("a") and packing.known_to_worker("b") is not packing.known_to_worker("a")
