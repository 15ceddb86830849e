import numpy as np
import pyarrow as pa
import xxhash

from streamchain.llm.arrow import ascii_lower, chunks, split_words, texts, word_hashes
from streamchain.llm.jaccard import shingle_sets

from . import data


def test_chunks_of_a_batch_hold_the_same_texts():
    column = [r[1] for r in data.hard_rows()] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(column), pa.array(range(len(column)))], ["text", "row"])
    for limit in (1, 100, 5000, 1 << 30):
        rows, found = [], []
        for part in chunks(iter([batch, batch.slice(0, 0)]), limit=limit):
            own = texts(part.column("text"))
            low = ascii_lower(own)
            assert own.to_pylist() == [t or "" for t in part.column("text").to_pylist()]
            assert low.to_pylist() == [data.ascii_lower(t).decode() for t in part.column("text").to_pylist()]
            first, words = split_words(low)
            assert [[w.encode() for w in words.slice(a, b - a).to_pylist()] for a, b in zip(first, first[1:])] == [data.words_ws(t.lower() if t is None else data.ascii_lower(t).decode()) if t else [] for t in part.column("text").to_pylist()]
            assert (word_hashes(words) == np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in words.to_pylist()], np.uint64)).all()
            token, at = shingle_sets(own, 4)
            found += [token[a:b].tobytes() for a, b in zip(at, at[1:])]
            rows += part.column("row").to_pylist()
        assert rows == list(range(len(column)))
        if limit == 1:
            want = found
        assert found == want
