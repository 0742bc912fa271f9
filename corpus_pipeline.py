"""From raw documents to tokens: the stages of the corpus, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pubweave.llm import bpe, exactdedup, langid, mixing, neardedup
from pubweave.llm.common import remove, shared_path
from pubweave.llm.queries import default_vocabulary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an identified language; those that the models reject go."""
    return langid.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exactdedup.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (0.8 of the five-word shingles in common), the document with the smallest id;
    SimHashes find them in the byte-position index by a tally of shared bytes, and whole shingle sets verify them."""
    return neardedup.drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source at its target weight: a row for every time that a text is taken."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row of the mix: its token ids, their number, and digests of the ids and of the text decoded from them."""
    return bpe.token_digests(docs, default_vocabulary, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("encode", encode),
]

#: The models of the first stage and the links of the third have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what one has written goes once the next has written its own."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
