"""Exact histogram of encoded lengths, and what every context limit would keep.

Documents are counted by encoded length: each task counts its own first, so one row per distinct
length leaves it. Running sums over the histogram then answer totals, quantiles and truncated
totals for every limit. The sums run in two steps, inside ranges of lengths and over ranges, so
even they are spread when lengths are many.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from slotwise.llm.bpe import encoder, vocabulary_path
from slotwise.llm.text import slices, text_bytes
from slotwise.session import materialise

RANGE = 64


def _count(batches, path: str):
    tool, total = encoder(path), {}
    for batch in batches:
        for piece in slices(batch, "text", 2 << 20):
            _, count = tool.encode(*text_bytes(piece.column("text")))
            for n, docs in zip(*(x.tolist() for x in np.unique(count, return_counts=True))):
                total[n] = total.get(n, 0) + docs
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["length", "docs"])


def length_histogram(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``length, docs``: documents by number of token ids, without special tokens.

    Null and empty texts have length 0. Repeated rows count each. Empty table: empty result.
    """
    text = docs.select(F.col("text").cast("string").alias("text"))
    counted = text.mapInArrow(partial(_count, path=tokenizer or vocabulary_path()), "length long, docs long")
    return materialise(counted.groupBy("length").agg(F.sum("docs").alias("docs")), "lengths")  # read more than once


def limits(histogram: DataFrame) -> DataFrame:
    """For every distinct length taken as context limit, what it keeps.

    ``docs``, ``tokens``: of this length. ``docs_within``, ``tokens_within``: no longer than it.
    ``docs_longer``, ``tokens_longer``: longer (suffix sums). ``truncated_tokens``: all documents
    cut at it. ``quantile``: share of documents no longer than it.
    """
    rows = histogram.withColumn("tokens", F.col("length") * F.col("docs")).withColumn("part", F.floor(F.col("length") / RANGE))
    after = Window.orderBy("part").rowsBetween(1, Window.unboundedFollowing)
    parts = rows.groupBy("part").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    whole = Window.partitionBy()
    parts = parts.select(
        "part",
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
        F.sum("d").over(whole).alias("d_all"), F.sum("t").over(whole).alias("t_all"),
    )
    rest = Window.partitionBy("part").orderBy("length").rowsBetween(1, Window.unboundedFollowing)
    summed = rows.join(parts, "part")
    longer = F.col("d_after") + F.coalesce(F.sum("docs").over(rest), F.lit(0))
    tokens_longer = F.col("t_after") + F.coalesce(F.sum("tokens").over(rest), F.lit(0))
    summed = summed.withColumn("docs_longer", longer).withColumn("tokens_longer", tokens_longer)
    within, tokens_within = F.col("d_all") - F.col("docs_longer"), F.col("t_all") - F.col("tokens_longer")
    return summed.select(
        "length", "docs", "tokens", within.alias("docs_within"), tokens_within.alias("tokens_within"), "docs_longer", "tokens_longer",
        (tokens_within + F.col("length") * F.col("docs_longer")).alias("truncated_tokens"), (within / F.col("d_all")).alias("quantile"),
    )


def at_limit(answers: DataFrame, limit: int) -> DataFrame:
    """``docs_within, tokens_within, docs_longer, truncated_tokens`` for any limit, from :func:`limits`."""
    top = F.max_by(F.struct("docs_within", "tokens_within"), F.when(F.col("length") <= limit, F.col("length")))
    found = answers.agg(top.alias("x"), F.max(F.when(F.col("length") <= limit, F.lit(True))).alias("some"), F.sum("docs").alias("n"))
    docs = F.when(F.col("some"), F.col("x.docs_within")).otherwise(F.lit(0))
    tokens = F.when(F.col("some"), F.col("x.tokens_within")).otherwise(F.lit(0))
    longer = F.coalesce("n", F.lit(0)) - docs
    return found.select(docs.alias("docs_within"), tokens.alias("tokens_within"), longer.alias("docs_longer"), (tokens + limit * longer).alias("truncated_tokens"))


def length_at(answers: DataFrame, share: float) -> DataFrame:
    """``length``: the smallest that at least ``share`` of the documents do not exceed, from :func:`limits`."""
    return answers.where(F.col("quantile") >= share).agg(F.min("length").alias("length"))
