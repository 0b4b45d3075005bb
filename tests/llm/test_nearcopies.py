from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from slotwise.llm import nearcopies
from slotwise.llm.nearcopies import _forest, _near, distance_at, fingerprint_of, keep_one_of_similar, shingle_hashes, similar_groups
from slotwise.llm.simhash import fingerprint, simhash_groups


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def cosine(a, b):
    return len(a & b) / (len(a) * len(b)) ** 0.5 if a and b else float(a == b)


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def by_distance(rows):
    """The doc_ids that stay if all pairs of fingerprints are compared."""
    h, at = shingle_hashes(pa.array([t for _, t in rows], pa.string()))
    sets = [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:])]
    fps = [int.from_bytes(fingerprint_of(s).tobytes(), "little") for s in sets]
    near = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if (len(sets[i]) > 0) == (len(sets[j]) > 0) and (fps[i] ^ fps[j]).bit_count() <= distance_at(0.8)]
    return sorted(rows[i][0] for i, r in enumerate(components(len(rows), near)) if r == i)


def edited(words, rng, edits):
    out = list(words)
    for k in rng.sample(range(len(out) // 8), edits):
        out[k * 8 + 3] = f"new{rng.random()}"
    return out


def text_of(rng, n=300):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def kept(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(r[0] for r in keep_one_of_similar(docs, **settings).select("doc_id").collect())


def test_distance_of_a_similarity():
    assert distance_at(1.0) == 0 and distance_at(0.8) == 104 and distance_at(0.0) == 256


def test_fingerprints_differ_as_their_cosine_says():
    rng, seen = random.Random(3), []
    for edits in (2, 6, 10, 14, 20):
        for _ in range(12):
            words = text_of(rng)
            one, two = " ".join(words), " ".join(edited(words, rng, edits))
            h, at = shingle_hashes(pa.array([one, two]))
            a, b = (np.unique(h[at[i] : at[i + 1]]) for i in (0, 1))
            bits = int(np.bitwise_count(fingerprint_of(a) ^ fingerprint_of(b)).sum())
            seen.append(bits - distance_at(cosine(shingles(one), shingles(two))))
    assert abs(np.mean(seen)) < 4 and np.std(seen) < 12


def test_chains_pass_over_no_near_pair():
    rng = np.random.default_rng(1)
    x = np.zeros((3000, nearcopies.LANES), np.uint64)
    for row, n in zip(x, rng.integers(80, 130, len(x))):
        for bit in rng.choice(512, n, replace=False):
            row[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
    assert (_near(x, 104) == (np.bitwise_count(x).sum(axis=1) <= 104)).all()


def test_forest_joins_what_all_pairs_join():
    rng = np.random.default_rng(2)
    fp = rng.integers(0, 1 << 63, (40, nearcopies.LANES), dtype=np.uint64)
    chain = [fp[0]]
    for _ in range(60):  # each is near the one before only
        step = np.zeros(nearcopies.LANES, np.uint64)
        for bit in rng.choice(512, 60, replace=False):
            step[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
        chain.append(chain[-1] ^ step)
    fp = np.concatenate([fp, np.array(chain)])[rng.permutation(40 + 61)]
    left, right = _forest(fp, 104)
    near = [(i, j) for i, j in itertools.combinations(range(len(fp)), 2) if int(np.bitwise_count(fp[i] ^ fp[j]).sum()) <= 104]
    assert components(len(fp), zip(left, right)) == components(len(fp), near)
    assert len(left) < len(fp)


def test_stage_drops_near_copies_beyond_four_bits(spark):
    rng = random.Random(7)
    rows, far = [], 0
    for i in range(40):
        words = text_of(rng)
        rows.append((2 * i, " ".join(words)))
        rows.append((2 * i + 1, " ".join(edited(words, rng, 6))))  # 30 of 296 shingles: a cosine of 0.9
        far += (fingerprint(rows[-1][1]) ^ fingerprint(rows[-2][1])).bit_count() > 4
    assert far > 20
    assert by_distance(rows) == list(range(0, 80, 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    assert sorted(r[0] for r in stage(spark, docs, "").select("doc_id").collect()) == list(range(0, 80, 2))


def test_stage_drops_what_op10_links(spark, docs):
    """Texts of one passage over and over and different ends: op10 links them, their sets of shingles are far apart."""
    rng, rows = random.Random(11), []
    passage = " ".join(f"p{i}" for i in range(7))
    for i in range(6):
        rows.append((i, " ".join([passage] * 60 + text_of(rng, 60))))
    rows += [(10 + i, " ".join(text_of(rng))) for i in range(6)]
    fps = [fingerprint(t) for _, t in rows]
    assert all((a ^ b).bit_count() <= 4 for a, b in itertools.combinations(fps[:6], 2))
    assert by_distance(rows) == [i for i, _ in rows]
    given = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    assert sorted(r[0] for r in stage(spark, given, "").select("doc_id").collect()) == [0, *range(10, 16)]
    group = {(r["doc_id"], r["text_hash"]): r["group"] for r in similar_groups(docs).collect()}
    for r in simhash_groups(docs).collect():
        assert group[r["doc_id"], r["text_hash"]] in {g for (i, _), g in group.items() if i == r["component_id"]}


def test_links_that_share_no_band(spark):
    """Kinds linked before the wider search are joined, and so is what the bands hang on them."""
    fp = [np.full(nearcopies.LANES, x, np.uint64) for x in (0, 0, (1 << 64) - 1, 0xAAAAAAAAAAAAAAAA)]
    rows = [(k, bytearray(f.tobytes()), [100 * b + (0 if k < 3 else k) for b in range(nearcopies.BANDS)]) for k, f in zip((1, 2, 3, 4), fp)]
    kinds = spark.createDataFrame(rows, "kind long, fp binary, bands array<long>")
    found = lambda links: None if (r := nearcopies.similar_roots(kinds, 104, links=links)) is None else sorted(map(tuple, r.collect()))
    assert found(None) == [(2, 1)]
    assert found(spark.createDataFrame([(3, 2)], "a long, b long")) == [(2, 1), (3, 1)]


def test_recall_of_pairs_at_0_85(spark):
    """Pairs at a cosine of 0.85 (0.74 of their shingles): nine of ten are found, and none below 0.7."""
    rng, rows = random.Random(5), []
    for i in range(150):
        words = text_of(rng)
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(edited(words, rng, 9)))]
    for i in range(150, 250):
        words = text_of(rng)
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(edited(words, rng, 20)))]
    assert all(0.83 < cosine(shingles(rows[2 * i][1]), shingles(rows[2 * i + 1][1])) < 0.87 for i in range(150))
    assert all(cosine(shingles(rows[2 * i][1]), shingles(rows[2 * i + 1][1])) < 0.7 for i in range(150, 250))
    stay = kept(spark, rows)
    assert sum(2 * i + 1 in stay for i in range(150)) <= 15
    assert all(2 * i + 1 in stay for i in range(150, 250)) and all(2 * i in stay for i in range(250))


def test_large_group_gives_one_document(spark):
    rng = random.Random(8)
    words = text_of(rng)
    rows = [(0, " ".join(words))] + [(i, " ".join(edited(words, rng, 3 + i % 5))) for i in range(1, 200)]
    rows += [(1000, "a b c"), (1001, "A  b\nc"), (1002, "a b"), (1003, ""), (1004, " ")]
    assert kept(spark, rows) == by_distance(rows) == [0, 1000, 1002, 1003]


def test_chunks_lose_no_link(spark, monkeypatch):
    rng = random.Random(9)
    words = text_of(rng)
    rows = [(i, " ".join(edited(words, rng, 4 + i % 9))) for i in range(150)]
    monkeypatch.setattr(nearcopies.similar_roots, "__defaults__", (16,))
    assert kept(spark, rows) == by_distance(rows)


def test_groups_of_the_given_documents(docs, rows):
    groups = {}
    for r in similar_groups(docs).collect():
        groups.setdefault(r["group"], []).append(r["doc_id"])
    assert sorted(min(g) for g in groups.values()) == by_distance(rows)


def test_odd_rows(odd, empty):
    stay = [(r["doc_id"], r["text"]) for r in keep_one_of_similar(odd).collect()]
    assert len(stay) == 7 and (None, "no number here") in stay
    assert keep_one_of_similar(empty).count() == 0


@pytest.mark.parametrize("n", [0, 1, 4, 5, 9000, 20000])
def test_shingles_of_any_length(n):
    text = " ".join(f"w{i}" for i in range(n))
    h, at = shingle_hashes(pa.array([text, None, text]))
    assert at.tolist() == [0, len(shingles(text)), len(shingles(text)), 2 * len(shingles(text))]
    assert fingerprint_of(np.unique(h[: at[1]])).tolist() == fingerprint_of(np.unique(h[at[2] :])).tolist()
