"""A corpus from raw documents: language, near copies, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; its
result is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamchain.llm import decontaminate, jaccard, langid, packing, pii
from streamchain.llm.components import cut
from streamchain.llm.queries import tokenizer_file
from streamchain.sources.checkpoint import own_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Words of a shingle, and percent of the union that near copies share.
SHINGLE, SHARED = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the prediction takes the place of ``lang``. Rejected ones go: null, without letters, or too far from their language for their length. Ids aren't looked at; repeated rows are judged alike."""
    model = langid.fit(spark, docs)
    found = langid.predict_rows(docs.select(*COLUMNS), model)
    return found.filter("not rejected").select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def keyed(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """The rows with a row_key, a hash of id and text: by it verdicts come back to their own rows, whether ids are null, repeated or neither.

    Different rows that share a key are told apart by a second hash, which then is their key: so
    two documents are taken for one only where both hashes, 128 bits, are the same. Keys that
    are shared are looked for by a shuffle of the hashes alone; as a rule there are none.
    """
    docs = docs.select(*COLUMNS).withColumn("row_key", F.xxhash64("doc_id", "text") if key is None else key)
    second = F.xxhash64("text", "doc_id", F.lit(1))
    shared = docs.select("row_key", second.alias("second")).groupBy("row_key").agg(F.min("second").alias("least"), F.max("second").alias("most"))
    shared = cut(shared.filter("least < most").select("row_key", F.lit(True).alias("shared")))
    if shared.isEmpty():
        return docs
    return docs.join(shared, "row_key", "left").withColumn("row_key", F.when(F.col("shared"), second).otherwise(F.col("row_key"))).select(*COLUMNS, "row_key")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id, and once. A document without words, or without id, is no one's copy.

    Documents are rows of one id and text: other texts of the same id are other documents. Of
    near copies that share the smallest id, any one stays.
    """
    docs = keyed(docs).withColumn("row_key", F.when(F.col("doc_id").isNotNull(), F.col("row_key")))
    found = cut(jaccard.join(spark, docs.select(F.col("row_key").alias("doc_id"), "text"), size=SHINGLE, percent=SHARED))
    linked = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("row_key"), "component_id").distinct()
    members = cut(linked.unionByName(linked.select(F.col("component_id").alias("row_key"), "component_id").distinct()))
    named = members.join(docs.select("row_key", "doc_id"), "row_key")
    first = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "row_key")).alias("first")).select("first.row_key")
    copies = members.select("row_key").join(first, "row_key", "left_anti")
    kept = docs.join(copies, "row_key", "left_anti")
    repeated = cut(found.filter("doc_id is not null").groupBy(F.col("doc_id").alias("row_key")).count().filter("count > 1").select("row_key"))
    if repeated.isEmpty():
        return kept.select(*COLUMNS)
    once = kept.join(repeated, "row_key", "left_semi").dropDuplicates(["row_key"])
    return kept.join(repeated, "row_key", "left_anti").select(*COLUMNS).unionByName(once.select(*COLUMNS))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark window. Null texts have none, and stay, as all do with an empty benchmark; rows of one id and text go or stay together, whatever other rows of the id do."""
    docs = keyed(docs)
    found = decontaminate.contamination(spark, docs.select(F.col("row_key").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = found.filter("contaminated").select(F.col("doc_id").alias("row_key")).distinct()
    return docs.join(hit, "row_key", "left_anti").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets; n_chars follows, but where the text is null and stays so. Ids aren't looked at, and every row stays, repeated ones too."""
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens. A null or empty text is its end token alone; every row is packed, repeated ones and those without id too; no documents make no pieces."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("PII", personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all that the stages keep of the documents. What lies between stages is in a folder below the shared one, which goes when the application ends."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = own_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learning a language model of letters, weighing labelers and packing have no form in SQL; tests hold the stages against plain code.
ORACLE_SQL = None
