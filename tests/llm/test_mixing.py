from __future__ import annotations

import random

import pytest

from slotwise.llm.mixing import UNIT, balanced_sample, fly, mix, mixed_documents, source_targets


def plain_targets(sizes):
    """Shares handed out and reshared until no source is above twice its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, rest, free = {s: 0.0 for s in names}, 1.5 * sum(sizes.values()), set(names)
    while free and rest > 1e-9:
        unit, over = rest / sum(weight[s] for s in free), 0.0
        for s in free:
            target[s] += weight[s] * unit
        for s in list(free):
            if target[s] >= 2 * sizes[s]:
                over += target[s] - 2 * sizes[s]
                target[s] = 2 * sizes[s]
                free.discard(s)
        rest = over
    return target


def test_targets(spark):
    for sizes in ({"a": 100, "b": 10, "c": 50, None: 7, "Z": 1000}, {"x": 5}, {"a": 0, "b": 10}, {f"s{i}": 10 * i + 1 for i in range(30)}):
        df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, copies long")
        got = {r["source"]: r["target"] for r in source_targets(df).collect()}
        assert got == pytest.approx(plain_targets(sizes))


def test_flights_keep_totals():
    rng = random.Random(1)
    sizes = [rng.randint(1, 400) for _ in range(500)]
    p0 = [0.37] * 500
    p = fly(sizes, [1] * 500, p0, p0, random.Random(2), land=False)
    assert sum(0 < x < 1 for x in p) <= 2
    assert sum(p) == pytest.approx(185, abs=1e-6)
    assert sum(x * z for x, z in zip(p, sizes)) == pytest.approx(0.37 * sum(sizes), rel=1e-6)
    landed = fly(sizes, [1] * 500, p0, p0, random.Random(2), land=True)
    assert set(landed) <= {0.0, 1.0} and abs(sum(landed) - 185) <= 1


def test_inclusion_probabilities_are_kept():
    sizes, hits = [3, 3, 8, 1, 0, 40, 2, 9], [0] * 8
    for seed in range(4000):
        for i, x in enumerate(fly(sizes, [1] * 8, [0.3] * 8, [0.3] * 8, random.Random(seed), land=True)):
            hits[i] += x
    assert all(abs(h / 4000 - 0.3) < 0.04 for h in hits)


def test_mix(docs):
    got = mix(docs, block=7).collect()
    assert len(got) == docs.count()
    by_source = {}
    for r in got:
        t = by_source.setdefault(r["source"], [0, r["target"], 0, 0])
        t[0] += r["size"] * r["times"]
        t[2] = max(t[2], r["size"])
        t[3] += r["size"]
        assert 0 <= r["times"] <= 2
    sizes = {s: t[3] for s, t in by_source.items()}
    want = plain_targets(sizes)
    for s, (taken, target, largest, _) in by_source.items():
        assert target == pytest.approx(want[s])
        assert abs(taken - target) <= 2 * largest
    again = mix(docs.repartition(5), block=7).collect()
    key = lambda r: (r["doc_id"], r["times"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixed_documents(docs, block=7).count() == sum(r["times"] for r in got)


def test_odd_rows(odd):
    got = mix(odd).collect()
    assert len(got) == odd.count()
    assert {r["source"] for r in got} == {"a", "b", "c", None}
    rows = mixed_documents(odd)
    assert rows.columns == odd.columns
    assert rows.count() == sum(r["times"] for r in got)


def test_empty_table(empty):
    assert mix(empty).count() == mixed_documents(empty).count() == 0


def test_nothing_to_draw(spark):
    assert balanced_sample(spark.createDataFrame([("a", 1, 5, 7, 1, 0, 0.0, 0.0)], UNIT)).count() == 1


def test_rows_that_share_an_id_are_drawn_one_by_one(spark):
    """Contents and sizes alike under one id, and without any: every source still comes near its target."""
    rows = [(None, "abc"[i % 10 // 4], " ".join(["w"] * (10 if i % 3 else 7 + i % 11)), i % 2) for i in range(4000)]
    rows += [(5, "a", "one two three", 0)] * 1000
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, copy int")
    got = mix(docs, block=100).collect()
    assert len(got) == 5000
    for source in "abc":
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["times"] * r["size"] for r in own) - own[0]["target"]) <= 2 * max(r["size"] for r in own)
        assert all(0 <= r["times"] <= 2 for r in own)
    taken = mixed_documents(docs, block=100)
    assert taken.count() == sum(r["times"] for r in got)
    sizes = {s: sum(len(r["text"].split()) for r in taken.collect() if r["source"] == s) for s in "abc"}
    assert sizes == {s: sum(r["times"] * r["size"] for r in got if r["source"] == s) for s in "abc"}
