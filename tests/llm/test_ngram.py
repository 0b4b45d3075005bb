from __future__ import annotations

import collections
import math
import zlib

import numpy as np
import pytest

from slotwise.llm.ngram import discounts, shard_of, train_and_score


def brute(rows):
    def held(doc):
        return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2

    texts = [(d, bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()).split()) for d, t in rows]
    one, two = collections.Counter(), collections.Counter()
    for d, w in texts:
        if not held(d):
            one.update([*w, "end"])
            two.update(zip(["begin", *w], [*w, "end"]))
    n, v, kinds = sum(one.values()), len(one), len(two)
    of_two = collections.Counter(two.values())
    before = collections.Counter(w for _, w in two)
    of_one = collections.Counter(before.values())
    d2, d1 = discounts([of_two[k] for k in (1, 2, 3, 4)]), discounts([of_one[k] for k in (1, 2, 3, 4)])
    take = lambda c, d: d[min(c, 3) - 1] if c else 0
    total, after = collections.Counter(), collections.defaultdict(list)
    for (a, _), c in two.items():
        total[a] += c
        after[a].append(c)

    def lower(w):
        spread = sum(take(c, d1) for c in before.values()) / kinds
        return (before[w] - take(before[w], d1)) / kinds + spread / (v + 1)

    def p(a, w):
        if not total[a]:
            return lower(w)
        c = two[a, w]
        return (c - take(c, d2)) / total[a] + sum(take(x, d2) for x in after[a]) / total[a] * lower(w)

    assert sum(p("begin", w) for w in one) + p("begin", "never seen") == pytest.approx(1)
    out = []
    for d, w in texts:
        tokens = [*w, "end"]
        base = sum(math.log10((one[t] + 1) / (n + v + 1)) for t in tokens)
        out.append((d, held(d), len(tokens), sum(one[t] > 0 for t in tokens), n, base, sum(math.log10(p(a, t)) for a, t in zip(["begin", *w], tokens))))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))
    got = sorted((tuple(r)[:7] for r in got), key=key)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5]) and g[6] == pytest.approx(w[6])


def test_scores_equal_brute_force(docs, rows):
    got = train_and_score(docs, shard_mb=0.05, block=5_000).collect()
    same(got, brute(rows))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_odd_rows(odd):
    same(train_and_score(odd).collect(), brute([(r["doc_id"], r["text"]) for r in odd.collect()]))


def test_empty_and_all_held_out(spark, empty):
    assert train_and_score(empty).count() == 0
    doc = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = train_and_score(spark.createDataFrame([(doc, "a b")], "doc_id long, text string")).first()
    assert (row["held_out"], row["n_known"], row["train_tokens"], row["base_score"]) == (True, 0, 0, 0.0)


def test_discounts():
    assert discounts([0, 0, 0, 0]) == (0.5, 1.0, 1.5)
    d = discounts([100, 40, 20, 10])
    assert 0 < d[0] < d[1] < d[2] < 3


def test_heavy_first_words_take_several_shards():
    v = np.full(1000, 5 << 60, np.uint64)
    w = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    none = (np.empty(0, np.uint64), np.empty(0, np.int64))
    assert len(set(shard_of(v, w, 16, none))) == 1
    heavy = (v[:1], np.array([4]))
    assert len(set(shard_of(v, w, 16, heavy))) == 4
    assert (shard_of(v, w, 16, heavy) == shard_of(v[::-1], w, 16, heavy)).all()
