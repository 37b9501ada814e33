"""A corpus-cleaning pipeline over ``documents``: five operators, each written and read again.

Every stage returns the columns of its input but the last, which returns tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenlake.llm import bpe, common, decontaminate, jaccard_join, pii, quality
from greenlake.llm import queries as q


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal quality model keeps, trained on the ratings of the documents at hand."""
    model = quality.train(docs, q.ratings(q.table(spark, sf_dir, "labels")))
    return quality.grade(docs, model).where("kept").select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; rows of equal id and text are one."""
    groups = jaccard_join.similar_documents(docs)
    first = groups.where("doc_id <=> component_id").select(F.col("doc_id").alias("_id")).distinct()
    kept = docs.join(first, docs["doc_id"].eqNullSafe(F.col("_id")), "left_semi")
    return kept.withColumn("_text", F.xxhash64("text")).dropDuplicates(["doc_id", "_text"]).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark text."""
    return decontaminate.decontaminate(docs, q.table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and disclosing terms replaced in the text, and n_chars to match."""
    clean = pii.sanitise(docs).select(*docs.columns)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of the ids and of the decoded bytes."""
    return bpe.encode_documents(docs, *q.tokenizer())


STAGES = [
    ("quality_classifier", good_documents),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("byte_bpe", tokens),
]

#: The classifier, the sketches and the tokenizer have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = q.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
