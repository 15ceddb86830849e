"""Personal data: span labelers vote, expectation-maximisation weighs them, and a classifier decides; DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The base patterns, written so that the engine cannot back up: a start inside a run of
# characters that the pattern's first part takes whole is never tried, except right after a
# match, since it would fail like the run's start.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Looser ones, which only the vote can make spans of.
AT_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[({] ?at ?[\])}] ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[A-Za-z0-9-]{1,63}+){1,8}+"
IP6 = r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
LOCAL_PHONE = r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"

#: Gazetteer and context words: fixed values.
TOP_LEVEL = "com org net edu gov mil int info biz name io ai app dev co uk de fr es it nl be ch at eu us ca au nz jp cn in br mx ru pl se no fi dk pt ie example test local".split()
CONTEXT = {
    "email": "mail|contact|write|reach|address|correo|courriel|@",
    "ip": r"\bip\b|addr|host|server|client|network|login|from|serveur|servidor",
    "card": "card|credit|debit|visa|master|amex|pay|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|cell|fax|dial|whatsapp|anruf|appel|llam",
}
AGAINST = r"version|release|build|isbn|issn|token|hash|sha|uuid|serial|\bpin\b|\bv ?$|section|chapter"
LABELERS = ("pattern", "gazetteer", "context", "shape", "border")


_SPAN = "struct<begin:int,end:int,body:string,left:string,right:string>"
#: Matches that are put in one array at a time; those arrays are joined then, so that a long text's many matches aren't copied for each.
_BATCH = 128


def _matches(text: Column, pattern: str, worth, hint: Column) -> Column:
    """Matches of the pattern as structs of begin, end (code points), body, and what stands left and right; those alone whose body is worth it. Null where the hint rules all out."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.arrays_zip(found.alias("body"), F.slice(between, 1, F.size(found)).alias("before"), F.slice(between, 2, F.size(found)).alias("after"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["before"])
        end = begin + F.length(x["body"])
        one = F.struct(begin.alias("begin"), end.alias("end"), x["body"].alias("body"), F.right(x["before"], F.lit(40)).alias("left"), F.left(x["after"], F.lit(8)).alias("right"))
        return F.struct(end.alias("at"), F.when(worth(x["body"]), F.concat(acc["found"], F.array(one))).otherwise(acc["found"]).alias("found"))

    def batches(steps: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{_SPAN}>>").alias("found"))
        each = F.transform(F.sequence(F.lit(1), F.size(steps), F.lit(_BATCH)), lambda i: F.slice(steps, i, F.lit(_BATCH)))
        both = F.aggregate(each, start, lambda acc, own: _append(acc, F.aggregate(own, F.struct(acc["at"].alias("at"), F.array().cast(f"array<{_SPAN}>").alias("found")), step)))
        return F.flatten(both["found"])

    # bound once as a lambda's variable, since an expression that is named twice is computed twice
    once = F.flatten(F.transform(F.filter(F.array(steps), lambda s: F.size(s) > 0), batches))
    return F.when(hint, once)


def _append(acc: Column, own: Column) -> Column:
    together = F.transform(F.array(own), lambda o: F.struct(o["at"].alias("at"), F.concat(acc["found"], F.array(o["found"])).alias("found")))
    return F.get(together, F.lit(0))


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits' checksum is a multiple of 10: from the right, every second digit counts twice, less 9 above 9."""
    each = F.transform(F.split(F.reverse(digits), "(?!^)(?=.)"), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _vote(positive: Column, negative: Column | None = None) -> Column:
    out = F.when(positive, 1)
    return (out.when(negative, -1) if negative is not None else out).otherwise(0)


def _labelled(kind: str, strict: bool, spans: Column) -> Column:
    """The spans with the labelers' votes: 1 for, -1 against, 0 silent."""

    def one(x: Column) -> Column:
        body, left = x["body"], F.lower(x["left"])
        digits = _digits(body)
        known = {
            "email": F.lower(F.regexp_extract(body, "([A-Za-z0-9-]+)$", 1)).isin(TOP_LEVEL),
            "ip": body.rlike(r":|^0*(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\."),
            "card": digits.rlike("^(?:3[0-9]|4|5[1-5]|6|2[2-7])"),
            "phone": digits.rlike("^(?:1[2-9]|[2-9])"),
        }[kind]
        shaped = {
            "email": body.rlike(r"^[A-Za-z0-9][^@]*[A-Za-z0-9]@?"),
            "ip": ~body.rlike(r"(?:^|\.)0[0-9]"),
            "card": body.rlike(r"^(?:[0-9]+|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})$"),
            "phone": body.rlike(r"^(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}$"),
        }[kind]
        glued = x["left"].rlike("[0-9A-Za-z_=\"]$") | x["right"].rlike("^[0-9A-Za-z_]")
        votes = (F.lit(int(strict)), _vote(known, ~known), _vote(left.rlike(CONTEXT[kind]), left.rlike(AGAINST)), _vote(shaped, ~shaped), _vote(~glued, glued))
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), x["begin"].alias("begin"), x["end"].alias("end"), F.lit(strict).alias("base"),
            *[v.cast("int").alias(name) for v, name in zip(votes, LABELERS, strict=True)],
            F.least(F.lit(3), F.floor(F.length(body) / 8)).cast("int").alias("size"),
        )

    return F.transform(F.coalesce(spans, F.array().cast(f"array<{_SPAN}>")), one)


def candidates(text: Column) -> Column:
    """All spans that a labeler may vote on, base ones first, by kind and begin; loose ones that touch a base span are left out."""
    at, plus = F.contains(text, F.lit("@")), F.contains(text, F.lit("+"))
    any_ = lambda _: F.lit(True)
    sized = lambda low, high: lambda body: F.when(F.length(body) >= low, F.length(_digits(body)).between(low, high)).otherwise(F.lit(False))
    checked = lambda low, high: lambda body: F.when(sized(low, high)(body), luhn(_digits(body))).otherwise(F.lit(False))
    number = text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}")
    base = [
        ("email", _matches(text, EMAIL, any_, at)),
        ("ip", _matches(text, IP, lambda b: b.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"), text.rlike(r"[0-9]\.[0-9]"))),
        ("card", _matches(text, CARD, checked(16, 19), number)),
        ("phone", _matches(text, PHONE, sized(8, 15), plus)),
    ]
    loose = [
        ("email", _matches(text, AT_EMAIL, any_, text.rlike(r"[\[({] ?at ?[\])}]"))),
        ("ip", _matches(text, IP6, any_, text.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:"))),
        ("card", _matches(text, CARD, checked(13, 15), number)),
        ("phone", _matches(text, LOCAL_PHONE, any_, text.rlike(r"[0-9]{3}[ .-][0-9]{4}"))),
    ]
    return F.concat(*[_labelled(k, True, s) for k, s in base]), F.concat(*[_labelled(k, False, s) for k, s in loose])


def spans(docs: DataFrame) -> DataFrame:
    """The rows with ``base`` and ``loose``, arrays of labelled spans of ``text``; a null text is empty."""
    base, loose = candidates(F.coalesce("text", F.lit("")))
    docs = docs.select("*", base.alias("__base"), loose.alias("__near"))
    free = F.filter("__near", lambda x: ~F.exists("__base", lambda b: (b["begin"] < x["end"]) & (x["begin"] < b["end"])))
    return docs.withColumn("__loose", free).drop("__near")


@dataclass(frozen=True)
class Classifier:
    """Weights of a logistic model of each kind: a constant, one a vote (for, against) of each labeler, and one a size class."""

    weights: dict[str, dict[str, float]]

    def accepts(self, span: Column) -> Column:
        out = F.lit(False)
        for k, kind in enumerate(KINDS):
            if w := self.weights.get(kind):
                logit = F.lit(w["constant"])
                for name in LABELERS:
                    logit += F.when(span[name] == 1, w[f"{name}+"]).when(span[name] == -1, w[f"{name}-"]).otherwise(0.0)
                for size in range(4):
                    logit += F.when(span["size"] == size, w[f"size{size}"]).otherwise(0.0)
                out = out | ((span["kind"] == k) & (logit >= 0))
        return out


def _features(row) -> list[str]:
    votes = [f"{name}{'+' if row[name] > 0 else '-'}" for name in LABELERS if row[name]]
    return ["constant", *votes, f"size{row['size']}"]


def reliabilities(rows: list, rounds: int = 50) -> list[float]:
    """Probability that each vote pattern (with its count ``n``) marks a real span, by expectation-maximisation.

    Given the truth, labelers are taken to vote independently; each has its own chance of each
    vote for real and for other spans. Starts from the share of votes in favour.
    """
    share = lambda r: sum(r[x] > 0 for x in LABELERS) / max(1, sum(r[x] != 0 for x in LABELERS))
    p = [min(0.95, max(0.05, share(r))) for r in rows]
    for _ in range(rounds):
        real = sum(r["n"] * q for r, q in zip(rows, p, strict=True))
        total = sum(r["n"] for r in rows)
        prior = (real + 1) / (total + 2)
        table = {}
        for name in LABELERS:
            for vote in (-1, 0, 1):
                own = [(r["n"], q) for r, q in zip(rows, p, strict=True) if r[name] == vote]
                table[name, vote] = (sum(n * q for n, q in own) + 0.5) / (real + 1.5), (sum(n * (1 - q) for n, q in own) + 0.5) / (total - real + 1.5)
        new = []
        for r in rows:
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[x, r[x]][0] / table[x, r[x]][1]) for x in LABELERS)
            new.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
        if max(abs(a - b) for a, b in zip(p, new, strict=True)) < 1e-6:
            break
        p = new
    return p


def _logistic(rows: list, p: list[float], rounds: int = 300, penalty: float = 1e-2) -> dict[str, float]:
    names = ["constant", *[f"{x}{s}" for x in LABELERS for s in "+-"], *[f"size{k}" for k in range(4)]]
    w, total = dict.fromkeys(names, 0.0), sum(r["n"] for r in rows)
    for k in range(rounds):
        slope = {x: penalty * v for x, v in w.items()}
        for r, q in zip(rows, p, strict=True):
            own = _features(r)
            gap = r["n"] / total * (1 / (1 + math.exp(-sum(w[x] for x in own))) - q)
            for x in own:
                slope[x] += gap
        w = {x: v - 2.0 * slope[x] for x, v in w.items()}
    return w


def train(found: DataFrame) -> Classifier:
    """The classifier from the vote patterns of all spans: labelers' reliabilities by kind, then a logistic model of what they imply.

    The driver gets a row for each pattern that occurs, a few hundred at most whatever the input.
    """
    each = found.select(F.explode(F.concat("__base", "__loose")).alias("s")).select("s.kind", *[f"s.{x}" for x in LABELERS], "s.size")
    rows = each.groupBy("kind", *LABELERS, "size").agg(F.count("*").alias("n")).collect()
    weights = {}
    for k, kind in enumerate(KINDS):
        own = sorted((r for r in rows if r["kind"] == k), key=lambda r: tuple(r[x] for x in (*LABELERS, "size")))
        if own:
            weights[kind] = _logistic(own, reliabilities(own))
    return Classifier(weights)


def _listed(array: Column) -> Column:
    ordered = F.array_sort(F.transform(array, lambda x: F.struct(x["kind"], x["begin"], x["end"])))
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["begin"], x["end"])), ",")


def detected(docs: DataFrame) -> DataFrame:
    """The rows with ``__base`` and ``__all``: base spans, and with them the spans that the classifier adds."""
    found = spans(docs)
    model = train(spans(docs.select("text")))
    return found.withColumn("__all", F.concat("__base", F.filter("__loose", model.accepts))).drop("__loose")


def find(docs: DataFrame) -> DataFrame:
    """Per document row: base spans by kind, their digest, and all spans.

    docs: doc_id, text; other columns are not read. A null text is empty and has no spans;
    repeated rows give a row each and count in training; an empty table gives none. Offsets
    are code points. Two passes over the texts, and nothing but counts of vote patterns is
    shuffled.
    """
    out = detected(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    kinds = F.transform("__base", lambda x: x["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    added = (F.size("__all") - F.size("__base")).cast("long").alias("n_added")
    return out.select("doc_id", *counts, F.sha2(_listed(F.col("__base")), 256).alias("base_sha256"), _listed(F.col("__all")).alias("spans"), added)


def redact(docs: DataFrame) -> DataFrame:
    """The rows with every span of ``text`` replaced by its kind in brackets; of spans that overlap, the first one's. A null text stays null."""
    columns = docs.columns
    out = detected(docs)
    ordered = F.array_sort(F.transform("__all", lambda x: F.struct(x["begin"], x["end"], x["kind"])))
    name = F.array(*map(F.lit, KINDS))
    text = F.col("text")

    def step(acc: Column, x: Column) -> Column:
        fresh = x["begin"] >= acc["at"]
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["begin"] - acc["at"]), F.lit("["), F.upper(F.get(name, x["kind"])), F.lit("]"))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(fresh, piece).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return out.withColumn("text", F.when(F.size("__all") > 0, done).otherwise(text)).select(*columns)
