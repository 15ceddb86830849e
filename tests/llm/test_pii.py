import hashlib
import random
import re
from collections import Counter

import numpy as np

from streamchain.llm import pii

from . import data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum((int(c) * 2 - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def base(text):
    out = []
    for kind, pattern in BASE.items():
        if kind == "email" and "@" not in (text or ""):
            continue  # the plain pattern takes quadratic time on long runs
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


EXTRA = [
    "a@b.c_x@y.z é 1.2.3.4.5.6.7.8 +1 234 567 89 4111 1111 1111 1111, +12345678", "256.1.1.1 1.1.1.1.1 @a.b x@y x@y.z. a.b@c-d.e.f-",
    "+1 (+123456789012) x 4111111111111111 2", "1 " * 5000, "0000255.1.1.001 1.2.3.4", "\U0001f600+1 (555) 555-0199\U0001f600 5500-0000-0000-0004", "4111 1111 1111 1111 1 5555555555554444",
    "a@b.c@d.e +1-2-3-4-5-6-7-8 +1()()5 ++4912345678",
]


def test_base_spans(spark):
    rows = [(r[0], r[1]) for r in data.hard_rows()] + list(enumerate(EXTRA, 1000))
    got = pii.find(data.plain_docs(spark, rows)).collect()
    seen = sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got)
    want = sorted((str(d), *(sum(x.startswith(k) for x in base(t)) for k in BASE), hashlib.sha256(",".join(base(t)).encode()).hexdigest()) for d, t in rows)
    assert seen == want
    texts = dict(rows)
    for r in got:
        if r.doc_id is not None:
            assert set(base(texts[r.doc_id])) <= set(filter(None, r.spans.split(",")))


def test_long_runs_take_linear_time(spark):
    rows = [(1, "a" * 200_000 + "@"), (2, "1." * 100_000), (3, "a.b" * 20_000 + "@" + "c.d" * 20_000), (4, "9" * 200_000)]
    got = {r.doc_id: r for r in pii.find(data.plain_docs(spark, rows)).collect()}
    assert got[3].n_email == 1 and got[1].n_email == 0 and got[2].n_ip == 50_000 // 2


def test_the_vote_adds_spans(spark):
    rows = [(k, f"write to me at user{k}@mail.example.com or call +1 (555) 555-01{k:02d}") for k in range(30)]
    rows += [(99, "phone (555) 555-0123 or mail bob [at] example [dot] com; card 378282246310005"), (98, "version 555 1234567 of the token")]
    got = {r.doc_id: r for r in pii.find(data.plain_docs(spark, rows)).collect()}
    assert got[99].n_added >= 1 and got[98].spans == "" and got[0].n_added == 0


def test_reliabilities_follow_agreement():
    rows = [dict(pattern=1, gazetteer=1, context=1, shape=1, border=1, size=1, n=50), dict(pattern=0, gazetteer=-1, context=-1, shape=-1, border=-1, size=1, n=50), dict(pattern=0, gazetteer=1, context=1, shape=1, border=1, size=1, n=5)]
    p = pii.reliabilities(rows)
    assert p[0] > 0.9 > 0.1 > p[1] and p[2] > 0.5


def plain_model(votes, size, n):
    """Posteriors by expectation-maximisation and the logistic weights that they imply, over matrices."""
    votes, n = np.array(votes), np.array(n, float)
    share = (votes > 0).sum(1) / np.maximum(1, (votes != 0).sum(1))
    p = np.clip(share, 0.05, 0.95)
    for _ in range(50):
        real, total = (n * p).sum(), n.sum()
        prior = (real + 1) / (total + 2)
        odds = np.full(len(n), np.log(prior / (1 - prior)))
        for column in votes.T:
            same = column[:, None] == column[None, :]
            odds += np.log(((same @ (n * p) + 0.5) / (real + 1.5)) / ((same @ (n * (1 - p)) + 0.5) / (total - real + 1.5)))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        done = np.abs(new - p).max() < 1e-6
        if done:
            break
        p = new
    x = np.concatenate([np.ones((len(n), 1)), votes > 0, votes < 0, np.array(size)[:, None] == np.arange(4)], axis=1).astype(float)
    w = np.zeros(x.shape[1])
    for _ in range(300):
        w -= 2.0 * (0.01 * w + x.T @ (n / n.sum() * (1 / (1 + np.exp(-x @ w)) - p)))
    return p, x @ w


def test_posteriors_and_added_spans_against_matrices(spark):
    rnd = random.Random(4)
    parts = ["mail bob{} [at] example [dot] com", "call (555) 555-01{:02d} now", "version 555-{:03d}-4567", "card 37828224631000{}", "10.0.0.{}", "me{}@mail.org", "id=(555) 555-01{:02d}x", "+1 (555) 555-01{:02d}", "a [at] b{} (dot) zz"]
    rows = [(k, " and ".join(rnd.choice(parts).format(rnd.randrange(100)) for _ in range(4))) for k in range(120)]
    docs = data.plain_docs(spark, rows)
    found = {r.doc_id: (r["__base"], r["__loose"]) for r in pii.spans(docs).collect()}
    kinds = {k: Counter() for k in range(4)}
    for b, near in found.values():
        for s in [*b, *near]:
            kinds[s.kind][tuple(s[x] for x in pii.LABELERS), s.size] += 1
    accepted = {}
    for k, counts in kinds.items():
        keys = sorted(counts, key=lambda c: (*c[0], c[1]))
        if keys:
            p, logit = plain_model([c[0] for c in keys], [c[1] for c in keys], [counts[c] for c in keys])
            own = pii.reliabilities([dict(zip(pii.LABELERS, c[0])) | {"size": c[1], "n": counts[c]} for c in keys])
            assert np.allclose(p, own, atol=1e-5)
            accepted |= {(k, *c): x >= 0 for c, x in zip(keys, logit)}
    want = {}
    for d, (b, near) in found.items():
        more = [s for s in near if accepted[s.kind, tuple(s[x] for x in pii.LABELERS), s.size]]
        want[d] = ",".join(f"{pii.KINDS[k]}:{x}:{y}" for k, x, y in sorted((s.kind, s.begin, s.end) for s in [*b, *more]))
    got = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    assert got == want and 0 < sum(len(near) for _, near in found.values()) and any(len(w.split(",")) > len(found[d][0]) for d, w in want.items() if w)


def test_redaction_and_no_documents(spark):
    docs = data.hard_docs(spark)
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[17] == "mail me: [EMAIL], or [PHONE]; [CARD] at [IP]." and got[3] is None and got[14] == "a" * 100_000
    assert pii.find(data.no_docs(spark)).collect() == [] and pii.redact(data.no_docs(spark)).collect() == []


def test_no_python_in_the_plan(spark, sf):
    plan = pii.find(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
