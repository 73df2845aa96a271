"""The corpus pipeline: stages that each apply one operator to what the one before kept.

Each stage's function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, line_dedup, queries, simhash
from tidemark.llm.bpe import encode_documents
from tidemark.llm.common import clear_since, mark, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found stay; those with `und` go."""
    return langid.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, without the lines it loses; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*[f"`{c}`" for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return simhash.keep_one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover a test passage go."""
    return decontam.drop_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text for every document that is left."""
    return queries.digests(encode_documents(docs, queries.tokenizer_path()))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

#: SQL can express neither the language network nor the fingerprints' components nor BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage read and wrote on its way goes when its result is written."""
    docs, point = queries.table(spark, sf_dir, "documents"), mark()
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
            clear_since(spark, point, keep=1)
    return docs
