"""License scans: digests of canonical texts, looked up among those of known licenses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import DIGESTS, NOTICES, TEXTS

#: Spellings that count as one, in words between single spaces. Fixed values.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"), ("organisation", "organization"), ("authoris", "authoriz"),
    ("recognis", "recogniz"), ("favour", "favor"), ("copyright owner", "copyright holder"), ("acknowledgement", "acknowledgment"), ("per cent", "percent"), ("https ", "http "),
)

#: What is known unless a caller says otherwise: (id, kind, text, or the digest of one).
KNOWN = (*((i, "text", t) for i, t in TEXTS), *((i, "digest", d) for i, d in DIGESTS), *((i, "notice", t) for i, t in NOTICES))
#: Without any of these, in lower case, a text has no line that either pattern leaves out.
MARKS = ("copyright", "(c)", "©", "all rights reserved")
#: Digests that may be broadcast, or held as a literal map.
FEW_KNOWN = 10_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What may stand before a line's words: comment leaders and box borders are nothing but ASCII punctuation and spaces.
_LEADER = r"\n[\x01-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f]*"
COPYRIGHT_LINE = _LEADER + r"(copyright |\(c\) |© |all rights reserved)[^\n]*"
_BLANK, _WORD = r"[\x01-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f]*", r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]"
#: Only lines with a year, a copyright sign or a placeholder: in wrapped texts, others may be prose that goes on with 'copyright notice ...'. One or two more lines go with it that end its paragraph. For texts whose line feeds are doubled, so that what follows a notice still begins with one.
COPYRIGHT_NOTICE = _LEADER + r"(copyright [^\n]*([0-9]{4}|\(c\)|©|<[^>\n]{0,80}>|\[[^\]\n]{0,80}\])|\(c\) |© |all rights reserved)[^\n]*" + rf"((\n\n[^\n]*{_WORD}[^\n]*){{1,2}}\n\n{_BLANK}\n)?"
PUNCTUATION = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
#: Where every notice holds this, other lines need no digest.
NOTICE_WORD = "licen"


def canonical(text: Column, left_out: str = COPYRIGHT_LINE) -> Column:
    """ASCII lower case, without lines that start with a copyright mark (a pattern), single spaces for punctuation, and one spelling."""
    text = F.concat(F.lit("\n"), F.translate(text, _UPPER, _LOWER))
    if left_out == COPYRIGHT_NOTICE:
        text = F.concat(F.replace(text, F.lit("\n"), F.lit("\n\n")), F.lit("\n\n"))
    text = F.regexp_replace(text, left_out, "\n")
    text = F.regexp_replace(text, PUNCTUATION, " ")
    for other, one in SPELLINGS:
        text = F.replace(text, F.lit(other), F.lit(one))
    return F.trim(text)


def digest(text: Column, left_out: str = COPYRIGHT_LINE) -> Column:
    return F.sha2(canonical(text, left_out), 256)


def known_digests(spark: SparkSession, known=KNOWN, left_out: str = COPYRIGHT_LINE) -> DataFrame:
    """license_id, kind and digest of the known texts, made with the same expressions as those of documents; digests of whole texts are taken as they are."""
    rows = [F.struct(F.lit(i).alias("license_id"), F.lit(k).alias("kind"), F.lit(t).alias("body")) for i, k, t in known]
    table = spark.range(1).select(F.explode(F.array(*rows).cast("array<struct<license_id:string,kind:string,body:string>>")).alias("k"))
    ready = F.col("k.kind") == "digest"
    table = table.select("k.license_id", F.when(ready, "text").otherwise(F.col("k.kind")).alias("kind"), F.when(ready, F.col("k.body")).otherwise(digest(F.col("k.body"), left_out)).alias("known"))
    return table.groupBy("kind", "known").agg(F.min("license_id").alias("license_id"))


def scan(spark: SparkSession, docs: DataFrame, known=KNOWN) -> DataFrame:
    """Per document row: the digest of its canonical text, the license whose whole text that is, and licenses whose notice is one of its lines.

    docs: doc_id, text. A null text is empty and matches nothing; repeated rows give a row each;
    an empty table gives none; other columns are not read. ``license_id`` is null without a
    match, ``notices`` the sorted distinct ids, comma-joined, or empty. A text that matches
    nothing without all lines that start with a copyright mark is looked up once more without
    those alone that are surely notices (COPYRIGHT_NOTICE), so wrapping does not matter; nor does
    a holder that takes up to two lines more, if a blank line follows. Texts are compared whole: a
    file that goes on after its license isn't found. The second digest is made only of texts that
    the first doesn't find and that hold a copyright mark; of others it would be the same.

    The known digests are as many as ``known`` has entries, whatever the documents are. Up to
    FEW_KNOWN they are broadcast to the hash joins on whole texts, and looked up as a literal
    map for notices: then nothing is shuffled. More whole texts are joined by a shuffle of
    digests; more notices are refused.
    """
    known = tuple(known)
    if sum(k == "notice" for _, k, _ in known) > FEW_KNOWN:
        raise ValueError(f"more than {FEW_KNOWN} notices")
    sent = F.broadcast if len(known) <= FEW_KNOWN else lambda t: t
    table = known_digests(spark, known)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    whole = table.filter("kind = 'text'").select(F.col("known").alias("digest"), F.col("license_id").alias("plain"))
    wrapped = known_digests(spark, known, COPYRIGHT_NOTICE).filter("kind = 'text'").select(F.col("known").alias("wrapped"), F.col("license_id").alias("other"))
    pairs = [F.lit(x) for r in table.filter("kind = 'notice'").select("known", "license_id").collect() for x in r]
    by = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    lines = F.split("text", "\n")
    if all(NOTICE_WORD in (t or "").lower() for _, k, t in known if k == "notice"):
        lines = F.filter(lines, lambda x: F.contains(F.lower(x), F.lit(NOTICE_WORD)))
    found = F.array_compact(F.transform(lines, lambda x: F.try_element_at(by, digest(x))))
    notices = F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("notices")
    docs = docs.select("doc_id", "text", digest(F.col("text")).alias("digest"), notices).join(sent(whole), "digest", "left")
    marked = reduce(Column.__or__, [F.contains(F.lower("text"), F.lit(m)) for m in MARKS])
    again = F.when(F.col("plain").isNull(), F.when(marked, digest(F.col("text"), COPYRIGHT_NOTICE)).otherwise(F.col("digest")))
    docs = docs.select("doc_id", "digest", "plain", "notices", again.alias("wrapped")).join(sent(wrapped), "wrapped", "left")
    return docs.select("doc_id", "digest", F.coalesce("plain", "other").alias("license_id"), "notices")
