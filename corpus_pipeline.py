"""A pipeline over ``documents``: toxicity, line dedup, near-duplicate texts, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; all but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trustlake.llm import line_dedup, mixing, ngram_join, sentencepiece_codec, toxicity
from trustlake.llm.common import table, written
from trustlake.llm.queries import tokenizer_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7 stay; the model learns from the labels of two folds of three."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.without_toxic(docs, toxicity.learn(docs.where(~toxicity.held_out()), labels))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier, or within one edit of such a line, go, and documents of which nothing is left."""
    return line_dedup.without_duplicate_lines(docs)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar texts the first document stays."""
    return ngram_join.one_of_each_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, decoded_ok, parity and ids of every row of the mix."""
    return sentencepiece_codec.encode_documents(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [("toxicity", reject_toxic), ("line dedup", drop_repeated_lines), ("n-gram Jaccard join", keep_one_of_similar), ("mixing", mix_sources), ("SentencePiece", tokenize)]

#: The stages fit a model and compare all texts, which SQL does not express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage kept is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
