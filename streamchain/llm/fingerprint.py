"""Document fingerprints: quartile bucket digests of hashed byte triplets."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import chunks, texts

BUCKETS = 256
#: Places, in a window of five bytes, of the bytes of each counted triplet.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
#: Text bytes of a stretch, and how many of these there are at most: beyond, they grow. The driver holds two ids for each.
STRETCH_BYTES, STRETCHES = 64 << 20, 20_000
#: A difference of so much, or more, is a likeness of 0.
FAR = 2 * BUCKETS
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _counts(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    total = np.zeros(BUCKETS, np.int64)
    for salt, (i, j, k) in enumerate(TRIPLETS):
        n = len(b) - k
        if n <= 0:
            continue
        h = (b[i : n + i] << np.uint32(16)) | (b[j : n + j] << np.uint32(8)) | b[k : n + k]
        h = (h + np.uint32(salt * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
        total += np.bincount(h >> np.uint32(24), minlength=BUCKETS)
    return total


def fingerprint(data: bytes) -> str:
    """Hexadecimal digest: length class, two quartile ratios, and a quartile (0 to 3) of each bucket.

    Equal bytes have equal digests. Fewer than three bytes have no triplet, and all buckets in quartile 0.
    """
    counts = _counts(data)
    q1, q2, q3 = (int(q) for q in np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]])
    code = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    four = code.reshape(-1, 4)
    length = min(255, round(8 * np.log2(1 + len(data))))
    ratio = lambda q: q * 15 // q3 if q3 else 0
    head = bytes((length, ratio(q1) << 4 | ratio(q2)))
    return (head + (four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]).astype(np.uint8).tobytes()).hex()


def difference(a: str, b: str) -> int:
    """Between two digests: steps between quartiles (three steps count six), ratios and length classes; bounded by its parts."""
    x, y = (np.frombuffer(bytes.fromhex(d), np.uint8).astype(np.int16) for d in (a, b))
    steps = sum(np.abs((x[2:] >> s & 3) - (y[2:] >> s & 3)) for s in (0, 2, 4, 6))
    sixes = sum(int((np.abs((x[2:] >> s & 3) - (y[2:] >> s & 3)) == 3).sum()) for s in (0, 2, 4, 6))
    ratios = abs(int(x[1] >> 4) - int(y[1] >> 4)) + abs(int(x[1] & 15) - int(y[1] & 15))
    return int(steps.sum()) + 3 * sixes + ratios + min(64, abs(int(x[0]) - int(y[0])))


def likeness(a: str, b: str) -> float:
    """1 for equal digests, falling with their difference to 0 at ``FAR``."""
    return 1.0 - min(difference(a, b), FAR) / FAR


def _fingerprints(batches):
    for batch in chunks(batches):
        column = texts(batch.column("text")).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, column), pa.int64()), pa.array([fingerprint(t.encode("utf-8", "surrogatepass")) for t in column], pa.string())], ["doc_id", "n_chars", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars (code points) and fingerprint of each document row; a null text is empty. Nothing is shuffled."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(_fingerprints, "doc_id long, n_chars long, fingerprint string")


def _pairs(batches):
    """Rows come in order of (stretch, ahead, doc_id, text); an ``ahead`` row only serves as the next of the row before it."""
    held = None

    def close(last, following):
        doc, text, own = last
        cut = len(text) - len(text) // 2
        edited = (text[:cut] + following[1][: len(text) // 2]).encode("utf-8", "surrogatepass")
        mark = fingerprint(edited)
        return doc, len(text), hashlib.sha256(edited).hexdigest(), own, mark, likeness(own, mark), likeness(own, following[2])

    for batch in chunks(batches):
        rows = []
        columns = (batch.column("doc_id").to_pylist(), texts(batch.column("text")).to_pylist(), batch.column("stretch").to_pylist(), batch.column("ahead").to_pylist())
        for doc, text, stretch, ahead in zip(*columns, strict=True):
            if ahead and (held is None or held[0] != stretch):
                continue  # a second row ahead, where a doc_id is repeated
            this = (doc, text, fingerprint(text.encode("utf-8", "surrogatepass")))
            if held is not None:
                assert held[0] == stretch, "a stretch ends with the first row of the next"
                rows.append(close(held[1], this))
            held = None if ahead else (stretch, this)
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        columns = zip(*rows, strict=True) if rows else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in RESULT.split(", ")])
    assert held is None


def _longs(values: list) -> Column:
    """A literal array, as one constant of the plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def _stretch(place: Column, cuts: list[int]) -> Column:
    """How many of the ascending cuts are at most ``place``: looked for among every g-th, then among g of them."""
    if not cuts:
        return F.lit(0)
    g = max(1, round(len(cuts) ** 0.5))
    coarse = F.size(F.filter(_longs(cuts[::g]), lambda c: c <= place))
    group = F.slice(_longs(cuts), (coarse - 1) * g + 1, F.lit(g))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * g + F.size(F.filter(group, lambda c: c <= place))).cast("int")


def edit_likeness(docs: DataFrame, stretches: int | None = None) -> DataFrame:
    """Each text's fingerprint beside that of its edited form and of the next document.

    Edited: the last half (rounded down) of the code points gives way to as many of the first
    ones, or all, of the next document by ascending doc_id; the first follows the last. Null
    texts are empty. Null doc_ids come first, rows of one doc_id are ordered by text. An empty
    table gives no rows; a lone document follows itself. Other columns are not read.

    The ids are cut into about equal stretches at quantiles, as many as the texts' bytes ask
    for. Every text moves once, to the partition of its stretch, and the first row of each
    stretch also goes to the end of the stretch before it. A task passes its stretch in order
    and holds a few MB of it. All rows of one id are in one stretch.
    """
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text", "coalesce(cast(doc_id as long), -9223372036854775808) place")
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = stretches or min(STRETCHES, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), held // STRETCH_BYTES))
    cuts = docs.agg(F.percentile_approx("place", [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0] or []
    cuts = sorted(set(cuts)) if n > 1 else []
    docs = docs.withColumn("stretch", _stretch(F.col("place"), cuts))
    first = {r[0]: r[1] for r in docs.groupBy("stretch").agg(F.min("place")).collect()}
    if not first:
        return docs.sparkSession.createDataFrame([], RESULT)
    order = sorted(first)
    before = {s: order[k - 1] for k, s in enumerate(order)}
    # by stretch, its first place and the stretch before it; looked up by index, and never for a stretch without rows
    firsts, befores = (_longs([table.get(s, 0) for s in range(len(cuts) + 1)]) for table in (first, before))
    ahead = F.struct(F.get(befores, F.col("stretch")).cast("int").alias("stretch"), F.lit(True).alias("ahead"))
    to = F.array_compact(F.array(F.struct("stretch", F.lit(False).alias("ahead")), F.when(F.get(firsts, F.col("stretch")) == F.col("place"), ahead)))
    placed = docs.select("doc_id", "text", "place", F.explode(to).alias("to")).select("doc_id", "text", "place", "to.*")
    placed = placed.repartitionById(len(cuts) + 1, F.col("stretch").cast("int"))
    return placed.sortWithinPartitions("stretch", "ahead", "place", F.coalesce("text", F.lit(""))).mapInArrow(_pairs, RESULT)
