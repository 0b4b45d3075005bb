from __future__ import annotations

import hashlib
import re

import pytest

from pyspark.sql import functions as F

from slotwise.llm.sketches import difference, digests, fingerprints, peeled, table


def brute(rows):
    rows = sorted(((d is None, d or 0, t or "") for d, t in rows), key=lambda r: r[:2])
    out = []
    for i, (_, d, t) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][2], len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        near = lambda a, b: len(a & b) / len(a | b)
        a, b, c = (set(x.split("\n")) for x in (t, edited, after))
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), near(a, b), near(a, c)))
    return out


def compare(df, **settings):
    got = fingerprints(df, **settings).collect()
    want = brute([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
    key = lambda r: r[:3]
    got_rows = sorted(((r["doc_id"] or 0, r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got), key=key)
    for g, w in zip(got_rows, sorted(want, key=key), strict=True):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:])
    return got


def test_equals_brute_force(docs):
    got = compare(docs, bucket_mb=0.1)
    by_text = {}
    for r, text in zip(sorted(got, key=lambda r: r["doc_id"]), (t for _, t in sorted((r["doc_id"], r["text"]) for r in docs.collect()))):
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]


def test_large_differences_are_retried(spark):
    texts = [(1, "\n".join(f"p{i}" for i in range(1500))), (2, "\n".join(f"q{i}" for i in range(900))), (3, "one"), (4, None), (None, "last\nlines")]
    compare(spark.createDataFrame(texts, "doc_id long, text string"))


def test_single_and_empty(spark, empty):
    compare(spark.createDataFrame([(5, "éa\nb\U0001f600")], "doc_id long, text string"))
    assert fingerprints(empty).count() == 0


def test_odd_rows(odd):
    got = fingerprints(odd).collect()
    assert len(got) == odd.count()
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (2, 3)}) == 1
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_peeling_gives_the_number_of_differences_or_nothing(spark):
    lines = lambda a, n: "\n".join(f"{a}{i}" for i in range(n))
    texts = [("same\n" + lines("a", n), "same\n" + lines("b", m)) for n in (0, 1, 3, 5) for m in (0, 1, 4)]
    pairs = [(a, b, len(set(a.split("\n")) ^ set(b.split("\n")))) for a, b in texts]
    df = spark.createDataFrame(pairs, "a string, b string, d int")
    cells = difference(table(digests(F.col("a"))), table(digests(F.col("b"))))
    for r in df.select("d", peeled(cells).alias("found")).collect():
        assert r["found"] in (r["d"], None)
    many = spark.createDataFrame([(lines("a", 200), "x")], "a string, b string")
    assert many.select(peeled(cells)).first()[0] is None


def test_no_python(docs):
    assert not re.search("Python|Pandas|Arrow", fingerprints(docs.limit(5))._jdf.queryExecution().toString())
