from __future__ import annotations

import collections
import hashlib
import zlib

import numpy as np

from pyspark.sql import functions as F

from slotwise.llm import substring
from slotwise.llm.frames import BIGGEST
from slotwise.llm.substring import intervals, remove_repeats
from slotwise.llm.text import pack, pack_ids, unpack, unpack_ids, window_hashes


def brute(rows, window):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[doc] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def found(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}


def test_equals_brute_force(docs, rows):
    for window, block in ((20, 10_000), (5, 2_000)):
        got = found(remove_repeats(docs, window=window, bucket_mb=0.05, block=block))
        assert got == brute(rows, window)


def test_partitioning_changes_nothing(docs):
    assert found(remove_repeats(docs)) == found(remove_repeats(docs.repartition(9), bucket_mb=0.02))


def test_repeats_inside_a_document(spark):
    df = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    row = remove_repeats(df, window=4).first()
    assert (row["n_words"], row["n_removed"], row["text"]) == (40, 38, "a b")


def test_odd_rows(odd):
    got = remove_repeats(odd, window=3).collect()
    assert len(got) == odd.count()
    texts = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in got}
    assert (2, 0, 0) in texts and (3, 0, 0) in texts and (4, 0, 0) in texts
    assert sum(r["doc_id"] == 1 and r["n_words"] == 7 and r["n_removed"] == 0 for r in got) == 2
    assert next(r for r in got if r["doc_id"] == 6)["n_removed"] == 200_000 - 997  # the words repeat after 997


def test_empty_table(empty):
    assert remove_repeats(empty).count() == 0


def test_intervals_merge():
    assert intervals(np.array([0, 1, 5, 30]), 20) == [(0, 25), (30, 50)]
    assert intervals(np.array([0, 20]), 20) == [(0, 40)]
    assert intervals(np.array([], int), 20) == []


def test_rolling_hash_is_the_polynomial():
    words = np.arange(1, 60, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for length in (1, 2, 3, 7, 20):
        got = window_hashes(words, length, substring.BASE)
        want = [sum(int(words[i + j]) * substring.BASE ** (length - 1 - j) for j in range(length)) % 2**64 for i in range(60 - length)]
        assert got.tolist() == want
    assert len(window_hashes(words[:3], 4, 3)) == 0


def test_packed_lists():
    values = np.array([0, 5, 3, 2**32 - 1, 0])
    assert unpack(pack(values)).tolist() == values.tolist()
    ids = np.array([-5, 2**62, -(2**62), 7])
    assert unpack_ids(pack_ids(ids)).tolist() == ids.tolist()


def test_parts_are_those_of_spark(spark):
    ids = spark.range(500).select((F.col("id") * 7919 - 300_000).alias("id"))
    for r in ids.select("id", F.pmod(F.xxhash64("id"), F.lit(13)).alias("p")).collect():
        assert substring._dest(np.array([r["id"]]), 13)[0] == r["p"]


def test_many_texts_without_doc_id_are_told_apart(spark):
    # Their crc32 agrees in its lower 16 bits.
    texts = collections.defaultdict(list)
    for i in range(2_000):
        text = f"only{i} here{i} seen{i} once{i}"
        texts[zlib.crc32(f"a b c d {text}".encode()) & 0xFFFF].append(text)
    pair = next(v for v in texts.values() if len(v) > 1)[:2]
    df = spark.createDataFrame([(None, f"a b c d {t}") for t in pair], "doc_id long, text string")
    for block in (1, 1_000):
        rows = remove_repeats(df, window=4, block=block).collect()
        assert sorted(r["n_removed"] for r in rows) == [0, 4]
    many = spark.range(200).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    ids, tags = np.full(200, BIGGEST), np.array([r[0] for r in many.select(F.xxhash64("text")).collect()])
    want = [r[0] for r in many.select(F.pmod(F.xxhash64(F.lit(BIGGEST), F.xxhash64("text")), F.lit(13))).collect()]
    got = substring._dest(ids, 13, tags)
    assert got.tolist() == want and len(set(want)) == 13
