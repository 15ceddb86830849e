"""Language identification: TF-IDF n-gram vectors against several clustered centroids a language."""

from __future__ import annotations

import sys
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import chunks, texts

_PREDICTED = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
#: What a text without letters gets.
NONE = "und"
#: Size of the hashed vectors, and documents that are counted at a time.
DIMENSIONS, ROWS = 4096, 128


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def counts(column: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed counts of letter n-grams (1 to 3, words marked off) of each text, and its number of letters."""
    lowered = [" " + t.lower() + " " for t in column]
    n = np.fromiter(map(len, lowered), np.int64, len(lowered))
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    doc = np.repeat(np.arange(len(n)), n)
    letter = _letters()[np.minimum(code, sys.maxunicode)]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[np.cumsum(n) - n] = True  # the mark before the first word
    code, doc, letter = np.where(letter, code, 0)[kept].astype(np.uint32), doc[kept], letter[kept]
    out = np.zeros(len(n) * DIMENSIONS, np.int64)
    for size in (1, 2, 3):
        if len(code) < size:
            continue
        last = len(code) - size + 1
        h = np.full(last, size, np.uint32)
        for i in range(size):
            h = (h ^ code[i : i + last]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        full = (doc[:last] == doc[size - 1 :]) & (letter[1 : 1 + last] if size == 3 else letter[:last] | letter[size - 1 :])
        out += np.bincount((doc[:last] * DIMENSIONS + (h >> np.uint32(20)))[full], minlength=len(out))
    return out.reshape(len(n), DIMENSIONS), np.bincount(doc, letter, len(n)).astype(np.int64)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


#: Rows of a sample, or languages, that may be broadcast.
FEW_IDS = 1_000_000
#: Letters at which length classes begin; likeness falls with fewer letters, and so does its floor.
LENGTHS = (0, 8, 16, 32, 64, 128, 256, 512)


def length_class(letters: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTHS, letters, side="right") - 1


def cut_to(text: str, letters: int) -> str:
    """The text up to and with so many letters, from the middle on where it has more before: what a short text of its language looks like."""
    at = np.flatnonzero(_letters()[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), sys.maxunicode)])
    if len(at) <= letters:
        return text
    begin = (len(at) - letters) // 2
    return text[at[begin] : at[begin + letters - 1] + 1]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # unit rows
    of: np.ndarray  # each centroid's language
    floor: np.ndarray  # a language's least likeness, by length class

    def predict(self, column: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language or -1, cosine, rejected) of each text."""
        found, letters = counts(column)
        near = _unit(np.log1p(found) * self.idf) @ self.centroids.T if len(self.centroids) else np.zeros((len(column), 1))
        best = near.argmax(axis=1)
        lang = np.where((letters > 0) & bool(len(self.centroids)), self.of[best] if len(self.centroids) else -1, -1)
        score = np.where(lang >= 0, np.clip(near[np.arange(len(best)), best], 0, 1), 0.0)
        far = score < self.floor[lang, length_class(letters)] if len(self.floor) else np.ones(len(best), bool)
        return lang, score, far | (lang < 0)


def _clusters(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit rows by cosine; starts from the mean's nearest row and then the farthest rows."""
    start = [int((rows @ rows.mean(axis=0)).argmax())]
    while len(start) < min(k, len(rows)):
        start.append(int((rows @ rows[start].T).max(axis=1).argmin()))
    centroids = rows[start]
    for _ in range(rounds):
        own = (rows @ centroids.T).argmax(axis=1)
        centroids = _unit(np.stack([rows[own == c].sum(axis=0) if (own == c).any() else centroids[c] for c in range(len(centroids))]))
    return centroids


def _counted(some: list) -> Iterator[np.ndarray]:
    """Counts of the rows of a sample, ROWS at a time: what is made of them is eight times as wide, or more."""
    for i in range(0, len(some), ROWS):
        yield np.stack([np.frombuffer(zlib.decompress(r["counts"]), "<u2") for r in some[i : i + ROWS]])


def fit(spark: SparkSession, docs: DataFrame, sample: int = 2400, per_language: int = 600, least: int = 8, clusters: int = 4, slack: float = 0.6) -> Model:
    """Learn from docs (doc_id, text, lang): rows with text and lang, whatever their ids, ``per_language`` documents a language and about ``sample`` in all.

    Every language is learned. The sample is bounded a language: the documents whose hashed ids
    and texts are least, repeated ones once, fewer of each if there are many languages, but ``least`` at least. Languages are
    counted over all rows (distinct ones, to some percent); then the rows whose hash lies below a share that holds twice the
    wanted number are ranked, so no language gathers in one task, and the texts of the sample
    are vectorised in tasks, whole and cut to the length of each class (LENGTHS). A language's
    floor for a class is ``slack`` times the likeness that all but a hundredth of its sample
    reach when cut to so few letters; a longer class's floor is no lower than a shorter one's.
    """
    labelled = docs.select(F.xxhash64(F.col("doc_id").cast("long"), "text", "lang").alias("row_key"), "text", "lang").filter("text is not null and lang is not null")
    known = labelled.groupBy("lang").agg(F.approx_count_distinct("row_key").alias("count"))
    many = known.count()
    each = max(least, min(per_language, sample // max(1, many)))
    place = F.pmod("row_key", F.lit(1 << 40))
    few = labelled.select("row_key", "lang").join(F.broadcast(known) if many <= FEW_IDS else known, "lang").filter(place < F.lit(2.0 * each * (1 << 40)) / F.col("count")).select("row_key", "lang").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(place, "row_key"))
    chosen = few.withColumn("rank", rank).filter(F.col("rank") <= each).select("row_key").distinct()

    def vectors(batches):
        for batch in chunks(batches, limit=4 << 20):
            column = texts(batch.column("text")).to_pylist()
            for k in (len(LENGTHS), *range(len(LENGTHS))):  # whole texts, and then cut ones
                some = column if k == len(LENGTHS) else [cut_to(t, max(LENGTHS[k], 4)) for t in column]
                found, letters = counts(some)
                yield pa.RecordBatch.from_arrays([batch.column("row_key"), batch.column("lang"), pa.array(np.full(len(some), k), pa.int32()), pa.array(letters), pa.array([zlib.compress(r.astype("<u2").tobytes(), 1) for r in np.minimum(found, 65535)], pa.binary())], ["row_key", "lang", "cut", "letters", "counts"])

    if each * many <= FEW_IDS:
        chosen = F.broadcast(chosen)
    rows = labelled.join(chosen, "row_key", "left_semi").mapInArrow(vectors, "row_key long, lang string, cut int, letters long, counts binary")
    rows = rows.filter("letters > 0").dropDuplicates(["row_key", "cut"]).collect()
    rows = sorted(rows, key=lambda r: (r.cut, r.row_key))
    languages = sorted({r["lang"] for r in rows})
    if not rows:
        return Model([], np.zeros(DIMENSIONS), np.zeros((0, DIMENSIONS)), np.zeros(0, np.int64), np.zeros((0, len(LENGTHS))))
    whole = [r for r in rows if r.cut == len(LENGTHS)]
    idf = np.log((1 + len(whole)) / (1 + sum((held > 0).sum(axis=0) for held in _counted(whole)))) + 1
    lang = np.array([languages.index(r["lang"]) for r in whole])
    unit = np.empty((len(whole), DIMENSIONS), np.float32)
    for k, held in enumerate(_counted(whole)):
        unit[k * ROWS : (k + 1) * ROWS] = _unit(np.log1p(held) * idf)
    parts = [_clusters(unit[lang == k], clusters) for k in range(len(languages))]
    del unit
    likeness: dict[tuple[int, int], list[np.ndarray]] = {}
    for c in range(len(LENGTHS)):
        some = [r for r in rows if r.cut == c]
        of = np.array([languages.index(r["lang"]) for r in some])
        for i, held in enumerate(_counted(some)):
            short, own = _unit(np.log1p(held) * idf), of[i * ROWS : (i + 1) * ROWS]
            for k in np.unique(own).tolist():
                likeness.setdefault((k, c), []).append((short[own == k] @ parts[k].T).max(axis=1))
    floor = np.zeros((len(languages), len(LENGTHS)))
    for (k, c), found in likeness.items():
        floor[k, c] = slack * float(np.quantile(np.concatenate(found), 0.01))
    return Model(languages, idf.astype(np.float32), np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts]), np.maximum.accumulate(floor, axis=1))


def predict_rows(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs (text, ...) with lang_pred, score and rejected; columns of these names give way.

    lang_pred is the language of the nearest centroid, score the cosine, and rejected tells
    whether the text is too far from that language for its length. A null text, or one without
    letters, gets ``und`` and 0, and is rejected. Repeated rows give a row each; an empty table
    gives none; only the text is looked at. Nothing is shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score", "rejected")

    def run(batches):
        fitted = sent.value
        names = np.array([*fitted.languages, NONE], object)
        for batch in chunks(batches):
            column = texts(batch.column("text")).to_pylist()
            found = [fitted.predict(column[i : i + ROWS]) for i in range(0, len(column), ROWS)]
            lang, score, far = (np.concatenate(x) for x in zip(*found, strict=True))
            more = [pa.array(names[lang], pa.string()), pa.array(score.astype(np.float64)), pa.array(far)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "lang_pred", "score", "rejected"])

    schema = T.StructType([*docs.schema.fields, *_PREDICTED])
    return docs.mapInArrow(run, schema)


def held_out() -> Column:
    """Whether crc32(doc_id as text) modulo 4 is 2; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of each document row, learned from the documents that are not held out."""
    model = fit(spark, docs.filter(~held_out()))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out())
    return predict_rows(docs, model).drop("text")
