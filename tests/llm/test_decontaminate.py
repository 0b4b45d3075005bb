from __future__ import annotations

import hashlib
import re

import pytest

from .conftest import SF
from slotwise.llm.decontaminate import contamination, digest, hits, without_contaminated


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    known = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            known.setdefault(tuple(w[i : i + n]), set()).add(None if item is None else str(item))
    out = []
    for doc, text in docs:
        w, found = words(text), set()
        hit = [False] * len(w)
        for n in {len(k) for k in known}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in known:
                    found |= known[tuple(w[i : i + n])]
                    hit[i : i + n] = [True] * n
        names = sorted(f for f in found if f is not None)
        out.append((doc, len(w), sum(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), any(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def test_equals_brute_force(docs, rows, benchmark):
    want = brute(rows, [tuple(r) for r in benchmark.select("item_id", "text").collect()])
    assert any(w[5] for w in want)
    for limit in (200_000, 0):  # broadcast, and joined by a shuffle
        assert sorted((tuple(r) for r in digest(contamination(docs, benchmark, limit)).collect()), key=str) == want
    assert without_contaminated(docs, benchmark).count() == sum(not w[5] for w in want)


def test_short_items_and_odd_rows(spark, odd):
    items = [(1, "alpha BETA"), (2, "ok"), (None, "idiot"), (4, None), (5, ".."), (2, "ok"), (9, " ".join(f"w{i}" for i in range(40, 53)))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = sorted((tuple(r) for r in digest(contamination(odd, benchmark)).collect()), key=str)
    assert got == brute(docs, items)
    kept = without_contaminated(odd, benchmark)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, None}


def test_shared_spans_of_ten_words_are_never_missed(spark):
    item = [f"q{i}" for i in range(60)]
    docs = [(i, "x y " + " ".join(item[i : i + 10]) + " z") for i in range(51)]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = contamination(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    assert all(r["n_hit"] == 10 for r in got)


def test_empty_tables(docs, benchmark):
    assert contamination(docs.limit(0), benchmark).count() == 0
    clean = contamination(docs, benchmark.limit(0))
    assert clean.count() == docs.count() and clean.where("n_hit > 0").count() == 0


def test_no_python(docs, benchmark):
    plan = hits(docs, benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
