from __future__ import annotations

import random

import numpy as np
import xxhash

from slotwise.llm import simhash
from slotwise.llm.components import components
from slotwise.llm.simhash import fingerprint, keep_one_of_each, near_links, simhash_groups


def plain_fingerprint(text):
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), seed=42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 4:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_fingerprints(rows):
    for _, text in rows[:60]:
        assert fingerprint(text) == plain_fingerprint(text)
    assert fingerprint(None) == fingerprint(" \n") == 0
    assert fingerprint("One two THREE") == plain_fingerprint("one two three")


def test_groups_equal_brute_force(docs, rows):
    fps = {d: plain_fingerprint(t) for d, t in rows}
    root = roots(sorted(set(fps.values())))
    least = {}
    for d, f in fps.items():
        least[root[f]] = min(d, least.get(root[f], d))
    got = simhash_groups(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {d: least[root[f]] for d, f in fps.items()}
    assert {r["doc_id"]: r["fp"] % 2**64 for r in got} == fps


def ball(n, seed=3):
    """Fingerprints around a few centres, most within 6 bits of theirs."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = set()
    while len(out) < n:
        f = rng.choice(centres)
        for b in rng.sample(range(64), rng.randint(0, 6)):
            f ^= 1 << b
        out.add(f)
    return sorted(out)


def test_links_connect_large_groups_dealt_in_chunks(spark):
    fps = ball(700)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    want = roots(fps)
    for chunk in (4096, 40):
        links = near_links(df, chunk=chunk)
        rows = [(a % 2**64, b % 2**64) for a, b in links.collect()]
        assert len(rows) < 10 * len(fps) * (1 if chunk == 4096 else 40)  # forests, not all pairs
        root = {v % 2**64: r for v, r in components(links).collect()}
        label = lambda f: root.get(f, int(np.uint64(f).view(np.int64)))  # noqa: B023, E731
        groups, wanted = {}, {}
        for f in fps:
            groups.setdefault(label(f), set()).add(f)
            wanted.setdefault(want[f], set()).add(f)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 200).selectExpr("id AS a", "id - 1 AS b")
    assert {r["root"] for r in components(links).collect()} == {0}
    assert components(links.limit(0)).count() == 0


def test_odd_rows(odd, spark):
    got = simhash_groups(odd).collect()
    assert len(got) == odd.count()
    blank = [r for r in got if r["fp"] == 0]
    assert {r["doc_id"] for r in blank} == {2, 3, 4} and {r["component_id"] for r in blank} == {2}
    assert sum(r["component_id"] == 1 for r in got) >= 2


def test_one_of_each_stays(odd, docs):
    kept = keep_one_of_each(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sum(r["doc_id"] == 1 for r in rows) == 1
    assert {2, 5, 6, 7, None} <= {r["doc_id"] for r in rows} and not {3, 4} & {r["doc_id"] for r in rows}
    assert keep_one_of_each(docs).count() == simhash_groups(docs).select("component_id").distinct().count()
    assert keep_one_of_each(docs.limit(0)).count() == simhash_groups(docs.limit(0)).count() == 0


def test_small_groups_and_forests_agree():
    fps = np.array(ball(60, seed=9), np.uint64)
    first = np.zeros(len(fps), np.int64)
    pairs = [(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps))]
    a, b = np.array(pairs).T
    near = set(simhash._near(fps[a], fps[b], first[a], 4).tolist())
    for k, (i, j) in enumerate(pairs):
        assert (k in near) <= ((int(fps[i]) ^ int(fps[j])).bit_count() <= 4)
