from __future__ import annotations

import itertools
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from slotwise.llm import toxicity
from slotwise.llm.text import span_hashes, text_bytes
from slotwise.llm.toxicity import _Field, marginals, without_toxic

BAD = ["idiotic", "moronish", "scumbag", "pathetical", "clownlike", "trashy"]


def sentence(rng, bad):
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(20, 80))]
    if bad:
        for _ in range(rng.randint(2, 5)):
            words[rng.randrange(len(words))] = rng.choice(BAD)
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    data = [(i, sentence(rng, i % 5 == 0), int(i % 5 == 0)) for i in range(900)]
    docs = spark.createDataFrame([d[:2] for d in data], "doc_id long, text string")
    return docs, spark.createDataFrame([(d[0], d[2]) for d in data], "doc_id long, toxic long")


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    for places, energy, length in (([0, 3, 6], [1.2, -0.5, 2.0], 7), ([2], [0.7], 6), ([4, 5], [3.0, -1.0], 6)):
        f = _Field(3)
        f.bias, f.move, f.start = -1.0, rng.normal(size=(2, 2)), rng.normal(size=2)
        extra = dict(zip(places, energy))
        total, toxic = 0.0, np.zeros(length)
        for tags in itertools.product((0, 1), repeat=length):
            s = f.start[tags[0]] + sum(f.bias + extra.get(t, 0) for t in range(length) if tags[t]) + sum(f.move[a, b] for a, b in itertools.pairwise(tags))
            total += np.exp(s)
            toxic += np.exp(s) * np.array(tags)
        assert marginals(places, energy, length, f.plain()) == pytest.approx((toxic / total)[places])


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(2)
    ids, tags = rng.integers(0, 4, (6, 5, 2)), rng.integers(0, 2, (6, 5))
    here = np.arange(5)[None, :] < np.array([5, 5, 3, 2, 1, 4])[:, None]
    ids, tags = np.where(here[:, :, None], ids, 0), np.where(here, tags, 0)

    def loss(f):
        out = 0.0
        for i, t, h in zip(ids, tags, here):
            n = int(h.sum())
            e = [f.theta[i[k]].sum() + f.bias for k in range(n)]
            score = lambda y: f.start[y[0]] + sum(e[k] for k in range(n) if y[k]) + sum(f.move[a, b] for a, b in itertools.pairwise(y))  # noqa: B023, E731
            out += np.log(sum(np.exp(score(y)) for y in itertools.product((0, 1), repeat=n))) - score(tuple(t[:n]))
        return out / len(ids)

    f = _Field(3)
    f.theta[1:], f.move, f.start = rng.normal(size=3), rng.normal(size=(2, 2)), rng.normal(size=2)
    theta, bias, move, start = f._gradient(ids, tags, here, ridge=0.0)
    for array, gradient in ((f.theta, theta), (f.move, move), (f.start, start)):
        for at in np.ndindex(array.shape):
            if array is f.theta and at == (0,):
                continue
            old, step = array[at], 1e-5
            array[at] = old + step
            up = loss(f)
            array[at] = old - step
            assert gradient[at] == pytest.approx((up - loss(f)) / (2 * step), abs=1e-6)
            array[at] = old


def test_held_out_documents_are_told_apart(corpus):
    docs, labels = corpus
    got = toxicity.toxicity(docs, labels).withColumn("held", toxicity.fold_of(F.col("doc_id")) == 1).join(labels, "doc_id")
    held = got.where("held").collect()
    assert len(held) > 200
    assert all(r["predicted"] == r["toxic"] for r in held)
    bad = next(r for r in held if r["toxic"])
    text = docs.where(F.col("doc_id") == bad["doc_id"]).first()["text"]
    assert bad["spans"] and all(text[s["begin"] : s["end"]] in BAD for s in bad["spans"])
    assert without_toxic(docs, labels).count() == got.where("predicted = 0").count()


def plain_tokens(text):
    """Tokens and the string their features are taken from."""
    out = []
    for run in re.findall("[0-9a-z\u0080-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text)):
        at = 0
        while at < len(run):
            stop = at + 1
            if ord(run[at]) < 0x800:
                while stop < len(run) and ord(run[stop]) < 0x800:
                    stop += 1
                out.append((run[at:stop], run[at:stop]))
            else:
                out.append((run[at], run[at : at + 3]))
            at = stop
    return out


def test_tokens_of_all_scripts():
    texts = ["Considerate considerably x1", "", "這是一個壞 蛋abc貓 мороз ÀÉ", "\U0001f600\U0001f600ok！好", " . ", "ไทยคำ"]
    buffer, offsets = text_bytes(pa.array(texts))
    begin, end, first, head, reach, lowered = toxicity.tokens(buffer, offsets)
    data = lowered.tobytes()
    for i, text in enumerate(texts):
        got = [(data[begin[k] : end[k]].decode(), data[begin[k] : reach[k]].decode()) for k in range(first[i], first[i + 1])]
        assert got == plain_tokens(text)
    every = toxicity.features(head, span_hashes(lowered, begin, reach))
    assert every[3, 0] == every[3, 1] and every[4, 0] != every[4, 1]  # eight bytes alike, the words not


def test_words_without_spaces_and_with_a_long_beginning(spark):
    """A toxic word inside a paragraph that is one run, and one that differs after its eighth byte."""
    rng = random.Random(3)
    clean = [chr(0x4E00 + i) for i in range(300)]
    data = []
    for i in range(900):
        bad = i % 4 == 0
        text = [rng.choice(clean) for _ in range(60)]
        words = [f"considerat{rng.choice(['e', 'ion', 'ely'])}" for _ in range(5)]
        if bad and i % 8:
            text[rng.randrange(20, 50)] = "壞蛋人"
        elif bad:
            words[2] = "considerXX"
        data.append((i, "".join(text) + " " + " ".join(words), int(bad)))
    docs = spark.createDataFrame([d[:2] for d in data], "doc_id long, text string")
    labels = spark.createDataFrame([(d[0], d[2]) for d in data], "doc_id long, toxic long")
    held = toxicity.toxicity(docs, labels).where(toxicity.fold_of(F.col("doc_id")) == 1).join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.98 * len(held) and sum(r["toxic"] for r in held) > 50


def test_long_labelled_documents_are_replaced_in_the_sample(corpus, monkeypatch):
    docs, labels = corpus
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, *rest, **more: seen.append(texts))
    long = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.repeat("text", F.lit(100))).otherwise(F.col("text")))
    toxicity.fit_on_labels(long, labels, sample=40, sample_bytes=2_000)
    assert len(seen[0]) == 80


def test_labels_of_the_held_out_fold_change_nothing(corpus):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", F.when(toxicity.fold_of(F.col("doc_id")) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.toxicity(docs, x).select("doc_id", "score").toPandas().sort_values("doc_id") for x in (labels, flipped))
    assert (a["score"].to_numpy() == b["score"].to_numpy()).all()


def test_odd_rows(odd, corpus, spark):
    model = toxicity.fit_on_labels(*corpus)
    got = toxicity.apply_model(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    blank = {r["score"] for r in got if r["doc_id"] in (2, 3, 4)}
    assert len(blank) == 1 and max(blank) < 0.5
    labels = spark.createDataFrame([(1, None), (None, 1), (5, 1), (6, 0), (6, 1)], "doc_id long, toxic long")
    assert toxicity.toxicity(odd, labels).count() == odd.count()
    kept = without_toxic(odd, labels)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_empty_tables(empty, corpus):
    docs, labels = corpus
    assert toxicity.toxicity(empty, labels).count() == 0
    scores = {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()}
    assert len(scores) == 1 and max(scores) < 0.7


def test_the_fit_keeps_few_numbers_a_token():
    rng = random.Random(3)
    words = [f"{rng.choice('abcdefgh')}{i}" for i in range(5_000)] + ["語言文字"]
    texts = [" ".join(rng.choices(words, k=500)) + (" vilest" if n % 2 else "") for n in range(800)]
    tracemalloc.start()
    model = toxicity.fit(texts, [n % 2 for n in range(800)], (1.0, 1.0))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model["known"]) and peak < 150 * 800 * 500


def test_the_fit_keeps_no_number_of_tokens_without_a_feature():
    """What it holds at once follows a part of the sample and the telling tokens, not all tokens."""
    rng = random.Random(3)
    words = [f"{rng.choice('abcdefgh')}{i}" for i in range(5_000)]
    texts = [" ".join(rng.choices(words, k=1_000)) + (" vilest" if n % 2 else "") for n in range(1_000)]
    tracemalloc.start()
    model = toxicity.fit(texts, [n % 2 for n in range(1_000)], (1.0, 1.0))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model["known"]) and peak < 40 * 1_000 * 1_000


def test_counts_of_features_are_those_of_whole_texts(monkeypatch):
    """A part of the sample at a time gives the same numbers; a feature of fewer than three toxic texts is none."""
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma", "語言文字", "delta"], k=rng.randint(0, 6))) + (" rare" if n == 1 else "") for n in range(60)]
    toxic = np.arange(60) % 2 == 1
    wanted = toxicity._frequencies(texts, toxic)
    monkeypatch.setattr(toxicity, "PART_BYTES", 64)
    found = toxicity._frequencies(texts, toxic)
    assert all(np.array_equal(a, b) for a, b in zip(wanted, found)) and wanted[1].min() >= 3
    at = np.flatnonzero(wanted[0] == next(iter(toxicity._features_of(["alpha"])))[0])
    assert wanted[1][at] == sum("alpha" in t for t, x in zip(texts, toxic) if x) and wanted[2][at] == sum("alpha" in t for t, x in zip(texts, toxic) if not x)
