from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from slotwise.llm import phrases as module
from slotwise.llm.phrases import _tiles, grow, phrases, places, shrink

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, longest=3, least=10, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        c = f.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            c.update(tuple(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {p[i : i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= 50 * c[p[i : i + k]]}
        scored = []
        for p, a in found.items():
            if p not in inside:
                score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def found(df, **settings):
    return sorted(tuple(r) for r in phrases(df, **settings).collect())


def test_equals_brute_force(docs):
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    want = plain(rows)
    assert want and found(docs) == want


@pytest.mark.parametrize("longest", [2, 4])
def test_other_lengths_and_small_tiles(spark, monkeypatch, longest):
    monkeypatch.setattr(module, "CELLS", 4)
    texts = ["a b c d a b, a b c d! x a b c d " * 9, "A B\tC d\na b c d", "d c b a d c " * 20, " ".join("abcdefgh"[i * i % 8] for i in range(900))]
    rows = [("en", t) for t in texts] + [(None, t) for t in texts[:2]] + [("und", texts[1])]
    df = spark.createDataFrame(rows * 3, "lang string, text string")
    assert found(df, max_words=longest, least=3, top=7) == plain(rows * 3, longest, 3, 7)


def test_sparse_and_dense_tiles_agree(monkeypatch):
    random = np.random.default_rng(0)
    parts = [np.unique(random.integers(0, 400, 300, dtype=np.int32), return_counts=True) for _ in range(9)]
    codes, n = [shrink(c, ordered=True) for c, _ in parts], [shrink(n.astype(np.int32)) for _, n in parts]
    rows = pa.RecordBatch.from_pydict({"lang": ["x"] * 9, "left": [0] * 9, "right": [1] * 9, "cells": [400] * 9, "codes": codes, "n": n})
    dense = [b.to_pylist() for b in _tiles([rows.slice(0, 4), rows.slice(4)], 5)]
    monkeypatch.setattr(module, "HELD", 100)
    assert dense == [b.to_pylist() for b in _tiles([rows], 5)]
    monkeypatch.setattr(module, "CELLS", 0)
    assert dense == [b.to_pylist() for b in _tiles([rows], 5)]


@pytest.mark.parametrize("kind", [np.int32, np.int64])
def test_numbers_come_back(kind):
    for values in ([], [5], [0, 0, 7, 1 << 30], [-3, 9, 2]):
        values = np.array(values, kind)
        for ordered in (False, True):
            assert grow(shrink(values, ordered)).tolist() == values.tolist()


def test_places():
    buffer, begin, end, place = places(pa.array(["a b.c", "", None, "! D\te", "f"]))
    assert [bytes(buffer[a:b]) for a, b in zip(begin, end)] == [b"a", b"b", b"c", b"d", b"e", b"f"]
    assert place.tolist() == [0, 1, 3, 5, 6, 8]


def test_odd_rows(odd):
    rows = [(r["lang"], r["text"]) for r in odd.select("lang", "text").collect()]
    assert found(odd) == plain(rows)
    assert found(odd, least=2) == plain(rows, least=2)


def test_empty_table(empty):
    assert found(empty) == []
