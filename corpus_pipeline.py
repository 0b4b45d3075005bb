"""From raw documents to token files: five stages, each written as Parquet and read again by the next.

``run`` returns the last stage's rows: for every document of the mix its doc_id, the number of ids
before it, its number of ids and their checksum, as read back from the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotwise.llm.decontaminate import without_contaminated
from slotwise.llm.mixing import mixed_documents
from slotwise.llm.nearcopies import keep_one_of_similar
from slotwise.llm.tokens import token_digests
from slotwise.llm.toxicity import without_toxic
from slotwise.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring 0.7 or more go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (op10's links, and a cosine of 0.8 of the five-word shingles), the document with the
    smallest doc_id stays."""
    return keep_one_of_similar(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them: not at all, once or twice."""
    return mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all that is left, read back."""
    return token_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("token_files", write_tokens),
]

# The fitted model, the sampling and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
