"""From raw documents to weighted, encoded training text.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents. Near copies: word shingles of five words, Jaccard 0.8 or more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import jaccard_join, line_dedup, mixing, quality_model, sentencepiece_bpe
from quern.llm.common import stash


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score under 0.3) go."""
    return quality_model.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 10 characters or more stay only in the smallest doc_id that holds them."""
    return line_dedup.deduped_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of smallest doc_id."""
    return jaccard_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target wants it: not at all to three times."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every text, with merge-dropout drawn anew for each copy of a document."""
    return sentencepiece_bpe.encoded_documents(docs, copies=True)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("n-gram jaccard join", near_copies), ("mixing", mix), ("sentencepiece", encode)]
#: A trained classifier and merge-dropout are not SQL; tests/llm compares each stage with a plain version and run() with the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
