import hashlib
import math

from streamchain.llm import fingerprint as fp

from . import data


def plain_fingerprint(text):
    """The digest from its definition, a byte and a bucket at a time."""
    b, mask = text.encode("utf-8", "surrogatepass"), 0xFFFFFFFF
    buckets = [0] * 256
    for salt, places in enumerate([(0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4)]):
        for at in range(len(b) - places[2]):
            h = b[at + places[0]] * 65536 + b[at + places[1]] * 256 + b[at + places[2]] + salt * 0x3C6EF372
            h = (h & mask) * 0x9E3779B1 & mask
            h = (h ^ h >> 15) * 0x85EBCA77 & mask
            buckets[h >> 24] += 1
    low, middle, high = (sorted(buckets)[k] for k in (63, 127, 191))
    quartiles = [(c > low) + (c > middle) + (c > high) for c in buckets]
    ratios = [q * 15 // high if high else 0 for q in (low, middle)]
    head = [min(255, round(8 * math.log2(1 + len(b)))), ratios[0] * 16 + ratios[1]]
    return bytes(head + [64 * p + 16 * q + 4 * r + s for p, q, r, s in zip(*[iter(quartiles)] * 4)]).hex()


def plain_likeness(a, b):
    x, y = bytes.fromhex(a), bytes.fromhex(b)
    steps = [abs((p >> s & 3) - (q >> s & 3)) for p, q in zip(x[2:], y[2:]) for s in (0, 2, 4, 6)]
    apart = sum(6 if d == 3 else d for d in steps) + abs((x[1] >> 4) - (y[1] >> 4)) + abs((x[1] & 15) - (y[1] & 15)) + min(64, abs(x[0] - y[0]))
    return 1 - min(apart, 512) / 512


def test_against_the_definition(spark):
    rows = [(r[0], r[1]) for r in data.hard_rows() if len(r[1] or "") < 3000] + [(1000 + k, data.prose(k, 7 * k)) for k in range(12)]
    rows = sorted({r[0]: r for r in rows if r[0] is not None}.values())
    want = []
    for k, (d, t) in enumerate(rows):
        t, u = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[: (len(t) + 1) // 2] + u[: len(t) // 2]
        marks = [plain_fingerprint(x) for x in (t, edited, u)]
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), marks[0], marks[1], plain_likeness(marks[0], marks[1]), plain_likeness(marks[0], marks[2])))
    assert sorted(tuple(r) for r in fp.edit_likeness(data.plain_docs(spark, rows), 3).collect()) == want


def _expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    out = []
    for i, (d, t, *_) in enumerate(rows):
        t, u = t or "", rows[(i + 1) % len(rows)][1] or ""
        edited = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        own, mark, following = (fp.fingerprint(x.encode()) for x in (t, edited, u))
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), own, mark, fp.likeness(own, mark), fp.likeness(own, following)))
    return sorted(out, key=str)


def test_edits_over_any_stretches(spark):
    for stretches in (1, 4, 40):
        got = sorted((tuple(r) for r in fp.edit_likeness(data.hard_docs(spark), stretches).collect()), key=str)
        assert got == _expected(data.hard_rows()), stretches


def test_one_document_follows_itself(spark):
    docs = data.plain_docs(spark, [(1, "abcd")])
    assert [tuple(r) for r in fp.edit_likeness(docs).collect()] == _expected([(1, "abcd")])


def test_no_documents(spark):
    out = fp.edit_likeness(data.no_docs(spark))
    assert out.collect() == [] and out.columns[:2] == ["doc_id", "n_chars"]


def test_likeness():
    texts = [data.prose(k, 300) for k in range(6)]
    marks = [fp.fingerprint(t.encode()) for t in texts]
    assert all(fp.likeness(m, m) == 1 for m in marks)
    small = fp.fingerprint(texts[0].replace("river", "brook", 1).encode())
    assert fp.likeness(marks[0], small) > max(fp.likeness(marks[0], m) for m in marks[1:])
    assert fp.likeness(fp.fingerprint(b""), marks[0]) == 0
    assert 0 <= fp.difference(marks[0], marks[1]) <= 6 * fp.BUCKETS + 30 + 64


def test_plain_fingerprints(spark):
    got = {(r.doc_id, r.fingerprint) for r in fp.fingerprints(data.hard_docs(spark)).collect()}
    assert got == {(d, fp.fingerprint((t or "").encode())) for d, t, *_ in data.hard_rows()}
