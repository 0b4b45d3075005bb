"""Small helpers on DataFrames shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BIGGEST = (1 << 63) - 1
MB = 1 << 20


def key_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """Exactly ``doc_id`` (a null one becomes the largest number, so it comes last) and ``text``."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(BIGGEST)).alias("doc_id"), F.col("text").cast("string").alias("text"), *more
    )


def original_id(name: str = "doc_id"):
    return F.when(F.col(name) != BIGGEST, F.col(name)).alias(name)


def parts_for(docs: DataFrame, mb: float) -> int:
    """How many parts of about ``mb`` MB of text the documents make; at least one."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(1, -(-int(total) // int(mb * MB)))


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them until no column of ``df`` is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out
