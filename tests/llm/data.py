"""Small tables with all that operators have to bear."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "the of and to in is was for on that with as by at from this river stone cloud wander quickly amber seventeen Été naïve 水 über word,word end. (see) A-B 3.14 x=1".split()


def prose(seed: int, n: int, words=WORDS) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(words) for _ in range(n))


def hard_rows():
    long_ = prose(1, 30_000)
    base = prose(2, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (7, base), (7, base),  # a repeated row
        (5, " ".join(near)), (9, base), (11, base + " tail"),  # near and exact copies
        (3, None), (4, ""), (6, " \n\t "), (8, "one"), (10, "one two three"), (12, "ONE TWO THREE"),
        (13, long_), (14, "a" * 100_000), (15, long_[: len(long_) // 2]), (2, "Nd, " * 400), (16, "\U0001f600 é ́a\u0000b\x1c　c" * 5),
        (None, base), (None, None), (17, "mail me: bob@example.com, or +1 (555) 555-0100; 4111 1111 1111 1111 at 10.0.0.1."),
        (0, "é"), (-5, prose(3, 50)), (18, prose(4, 13)), (19, prose(4, 13)), (20, "x " + prose(4, 13) + " y"),
    ]
    return [(d, t, None if i % 5 == 4 else ("en", "de")[i % 2], None if i % 4 == 3 else "s", None if t is None or i % 3 == 2 else len(t)) for i, (d, t) in enumerate(rows)]


def hard_docs(spark):
    """With extra columns, whose names clash with those that operators use or return."""
    docs = spark.createDataFrame(hard_rows(), SCHEMA).repartition(3)
    names = "fingerprint n_words seq block shard stretch place ahead doc n held_out lang_pred score rejected digest component_id signature start length spans base kind known license_id e s item_id row_key".split()
    return docs.withColumns({n: F.lit(-1) for n in names})


def plain_docs(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words_ws(text):
    return (text or "").encode("utf-8", "surrogatepass").split()


def ascii_lower(text):
    return (text or "").encode("utf-8", "surrogatepass").lower()
