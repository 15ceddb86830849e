"""Token counts of a unigram tokenizer without building its tokens."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import chunks, texts

RESULT = "doc_id long, n_tokens long, score double"
#: What an unknown character costs beyond the worst piece: a fixed value of unigram tokenizers.
UNKNOWN_PENALTY = 10.0
MARK = "▁"
#: Entries of the cache of segments; it starts anew beyond.
CACHE = 400_000


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) by id from a sentencepiece file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.piece_size())]


class Counter(dict):
    """Segment -> (pieces, score) of its best path, kept as it is asked for.

    An automaton over the vocabulary lists the pieces that end at each character, the longest
    first. The best score and its count of pieces are carried from character to character;
    a later candidate replaces an earlier one only if its score is greater, so of equal
    scores the one with the longest last piece stays, as in the tokenizer. A character that
    is no piece costs the unknown score, and counts as its UTF-8 bytes (byte fallback) or as
    one piece for a run of such characters.
    """

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        pieces = {p for p, _ in vocabulary}
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        #: No piece crosses from a character to a following space, nor holds a line end: then segments are independent.
        self.splits = self.bytes and not any("\n" in p or MARK in p.lstrip(MARK) for p in pieces)

    def __missing__(self, segment: str) -> tuple[int, float]:
        n = len(segment)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        at, best, pieces, single = 0, None, 0, False

        def close(end: int) -> None:
            nonlocal best, pieces, single
            lone = False
            if not single and (best is None or score[end - 1] + self.unknown > best):
                best, lone = score[end - 1] + self.unknown, True
                own = len(segment[end - 1].encode("utf-8", "surrogatepass")) if self.bytes else not unknown[end - 1]
                pieces = count[end - 1] + own
            score[end], count[end], unknown[end] = best, pieces, lone
            best, single = None, False

        for last, (size, value) in self.automaton.iter(segment):
            while at < last:
                at += 1
                close(at)
            begin = last + 1 - size
            single |= size == 1
            if best is None or score[begin] + value > best:
                best, pieces = score[begin] + value, count[begin] + 1
        while at < n:
            at += 1
            close(at)
        if len(self) >= CACHE:
            self.clear()
        if n <= 64:
            self[segment] = (count[n], score[n])
        return count[n], score[n]

    def of(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        text = MARK + text.replace(" ", MARK)
        parts = _SEGMENTS.findall(text) if self.splits else [text]
        found = [self[p] for p in parts]
        return sum(f[0] for f in found), sum(f[1] for f in found)


_SEGMENTS = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")


def count_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per document row: how many tokens the unigram tokenizer makes of its text, and the score of that split.

    docs: doc_id, text. A null or empty text has no tokens; repeated rows give a row each; an
    empty table gives none; other columns are not read. Spaces become the mark U+2581 and one
    is put in front, as the vocabulary expects. Nothing is shuffled, and a task keeps only the
    cache of segments beside its batch.
    """

    def run(batches):
        counter = Counter(load_vocabulary(vocabulary_path))
        for batch in chunks(batches):
            found = [counter.of(t) for t in texts(batch.column("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.float64())], ["doc_id", "n_tokens", "score"]
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, RESULT)
