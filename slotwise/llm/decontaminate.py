"""Benchmark passages in documents, by winnowing.

Method: of every ``window`` consecutive words (10) the smallest hash of its 5-word grams is kept,
with its place, as fingerprint. Two equal windows keep the same gram at the same place, so every
shared span of 10 words or more is found. Test windows are joined to training windows by
fingerprint and place; a hit is then extended to the whole window and compared word by word, and
the windows of a document merge into spans. Items of fewer words are one window of their own
length, whose only gram is all of it.

Only DataFrame functions run here. At scale: the documents are not shuffled, as long as the
distinct test windows stay below ``broadcast_rows`` (they are counted first); above, both sides
are joined by a shuffle. Windows shared by many items are one row with the list of items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotwise.llm.frames import BIGGEST, fresh, key_and_text, original_id
from slotwise.session import materialise

WINDOW = 10
GRAM = 5
BROADCAST_ROWS = 200_000
# Words are runs of a-z, digits and characters beyond ASCII.
BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """Words with A-Z lowered; other capitals stay. Null text has none."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    return F.filter(F.split(F.coalesce(lowered, F.lit("")), BREAK), lambda w: w != "")


def _fingerprint(hashes: str, at: Column, length: int) -> Column:
    """The smallest gram hash of the window of word hashes at ``at`` (from 0); its low three bits are its place."""
    gram = GRAM if length >= WINDOW else length
    grams = [
        F.xxhash64(F.lit(length), *(F.get(F.col(hashes), at + (k + j)) for j in range(gram))).bitwiseAND(F.lit(~7)).bitwiseOR(F.lit(k))
        for k in range(length - gram + 1)
    ]
    return F.least(*grams) if len(grams) > 1 else grams[0]


def _windows(rows: DataFrame, length: int) -> DataFrame:
    """A row per window of ``length`` words with its fingerprint; ``rows`` has ``words`` and ``hashes``."""
    many = F.size("hashes")
    starts = F.when(many >= length, F.sequence(F.lit(0), many - length)).otherwise(F.array().cast("array<int>"))
    return rows.withColumn("at", F.explode(starts)).withColumn("fp", _fingerprint("hashes", F.col("at"), length)).withColumn("length", F.lit(length))


def _hashed(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("words", words_of(F.col("text"))).drop("text")
    return rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``length, fp, passage, items``: the distinct windows of all items and the items that hold them."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = _hashed(items).where(F.size("words") > 0)
    parts = [_windows(items, WINDOW)] + [_windows(items.where(F.size("words") == n), n) for n in range(1, WINDOW)]
    out = None
    for part in parts:
        passage = F.array_join(F.slice("words", F.col("at") + 1, F.col("length")), " ")
        part = part.select("length", "fp", passage.alias("passage"), "item_id")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("length", "fp", "passage").agg(F.collect_set("item_id").alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id, text_hash, begin, end, items``: windows of documents that are windows of items (word numbers, end exclusive)."""
    known = materialise(benchmark_windows(benchmark), "benchmark-windows")
    size = {r["length"]: r["n"] for r in known.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ten rows
    keyed = key_and_text(docs)
    rows = _hashed(keyed.withColumn("text_hash", F.xxhash64("text")))
    out = None
    for length in sorted(size) or [WINDOW]:
        test = known.where(F.col("length") == length).select("fp", "passage", "items")
        if size.get(length, 0) <= broadcast_rows:
            test = F.broadcast(test)
        found = _windows(rows, length).select("doc_id", "text_hash", "at", "words", "fp").join(test, "fp")
        passage = F.array_join(F.slice("words", F.col("at") + 1, length), " ")
        # Not written as an equality, which Spark would make a join key and so build every window's text.
        found = found.where(F.array_contains(F.array("passage"), passage))
        found = found.select("doc_id", "text_hash", F.col("at").alias("begin"), (F.col("at") + length).alias("end"), "items")
        out = found if out is None else out.unionByName(found)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id, text_hash, n_words, n_hit, items`` for every row of ``docs``; ``items`` is sorted as strings.

    Null or empty text has no words and no hits; so has a table without items. Null item ids hit
    but are not listed. Null doc_ids are kept as one id, last. Rows that share doc_id and text
    are counted once and get the same result. Other columns are ignored.
    """
    found = materialise(hits(docs, benchmark, broadcast_rows).dropDuplicates(["doc_id", "text_hash", "begin", "end"]), "hits")
    key = ["doc_id", "text_hash"]
    earlier = Window.partitionBy(*key).orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.col("begin"), F.coalesce(F.max("end").over(earlier), F.lit(0)))
    covered = found.select(*key, F.greatest(F.col("end") - reached, F.lit(0)).alias("new")).groupBy(*key).agg(F.sum("new").alias("n_hit"))
    listed = found.select(*key, F.explode("items").alias("item")).distinct().groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("items"))
    per_text = covered.join(listed, key, "left")
    rows = key_and_text(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    joined = rows.join(per_text, key, "left")
    return joined.select(
        *key, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns as they are."""
    key, hashed = fresh(docs, "_id", "_hash")
    bad = hits(docs, benchmark, **settings).select(F.col("doc_id").alias(key), F.col("text_hash").alias(hashed)).distinct()
    marked = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(BIGGEST))).withColumn(hashed, F.xxhash64(F.col("text").cast("string")))
    return marked.join(materialise(bad, "contaminated"), [key, hashed], "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def digest(rows: DataFrame) -> DataFrame:
    """The contract's columns from :func:`contamination`."""
    return rows.select(
        original_id(), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
