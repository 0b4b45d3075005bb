from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from .conftest import SF
from slotwise.llm.language import BINS, SMOOTHING, STRENGTH, TEMPER, address, declared, fuse, page_languages, trigrams, visible
from slotwise.llm.text import text_bytes


def test_addresses():
    assert address("https://www.a.example.org:80/x?y#z") == ("www.a.example.org", "example.org", "org")
    assert address("http://10.0.0.1/") == ("10.0.0.1", "0.1", "")
    assert address(None) == address("http://[bad") == ("", "", "")
    assert declared("<!doctype html><HTML class=a LANG='DE-at'>") == "de" and declared(None) == declared("<html>") == ""
    assert visible("<p>a</p><script>var b</script><!-- c --><nav>d</nav> e&amp;f").split() == ["a", "e", "f"]


@pytest.mark.parametrize("part", ["<nav ", "<html ", "<!--", "<script>", "<", "<html lang", "&", "<nav>x", "<html><html lang = "])
def test_hostile_pages_take_linear_time(part):
    began = time.time()
    for n in (100_000, 400_000):
        visible(part * (n // len(part)))
        declared(part * (n // len(part)))
    assert time.time() - began < 10


def test_unclosed_markup():
    assert visible("a <nav>b c<p>d").split() == ["a", "b", "c", "d"]
    assert visible("a <!-- b > c <footer>x</footer> d <script>y</SCRIPT > e < f").split() == ["a", "c", "d", "e", "<", "f"]
    assert declared("<html><p>x<HTML xml:lang='fr' class='lang=de' lang=es>") == "es" and declared("<html lang=") == ""


def test_fusion_equals_brute_force(spark):
    """From given text evidence, by the rule in plain numbers."""
    rng = random.Random(2)
    names = ["de", "en", "fr"]
    model = {"languages": names, "log_p": np.log(np.array([[(i + 1) * (b % 7 + 1) % 11 + 1 for b in range(BINS)] for i in range(3)], float))}
    model["log_p"] -= np.log(np.exp(model["log_p"]).sum(axis=1, keepdims=True))
    hosts = ["a.x.de", "b.x.de", "c.y.fr", "d.com"]
    pages = [(i, f"http://{rng.choice(hosts)}/{i}", rng.choice(["", "<html lang=de>", "<html lang=en>"]) + "".join(rng.choice("abcdef ") for _ in range(rng.choice([0, 5, 60])))) for i in range(60)]
    evidence = []
    for i, url, html in pages:
        bins, _ = trigrams(*text_bytes(pa.array([visible(html)], pa.large_string())))
        score = model["log_p"][:, bins].sum(axis=1) * TEMPER
        q = np.exp(score - score.max())
        evidence.append((*address(url), declared(html), q / q.sum(), len(bins) > 0))
    part = lambda e: np.round(e[4] * 1e6) / 1e6 if e[5] else np.zeros(3)
    want = {}
    for (i, _, _), e in zip(pages, evidence):
        others = [o for o in evidence if o is not e]
        total = lambda key: sum((part(o) for o in others if key is None or o[key] == e[key]), np.zeros(3))  # noqa: B023, E731
        overall = total(None) + SMOOTHING
        domain = (total(1) + STRENGTH * overall / overall.sum()) / (total(1).sum() + STRENGTH)
        host = (total(0) + STRENGTH * domain) / (total(0).sum() + STRENGTH)
        logs = np.log(e[4]) + np.log(host) + np.log((total(2) + SMOOTHING) / (overall + 2 * SMOOTHING))
        if e[3]:
            logs += np.log((total(3) + SMOOTHING) / (overall + 2 * SMOOTHING))
        p = np.exp(logs - logs.max())
        want[i] = p / p.sum()
    got = fuse(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()
    for r in got:
        assert r["posterior"] == pytest.approx(want[r["page_id"]].tolist(), abs=1e-6)
        assert r["lang"] == names[int(np.argmax(r["posterior"]))]


def test_pages_get_their_language(spark, docs):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = page_languages(pages, docs).collect()
    paths = {r["page_id"]: r["url"].split("/")[3] for r in pages.collect()}
    assert len(got) == len(paths)
    assert sum(r["lang"] == paths[r["page_id"]] for r in got) >= 0.95 * len(got)
    assert all(abs(sum(r["posterior"]) - 1) < 1e-9 and r["probability"] == max(r["posterior"]) for r in got)


def test_host_and_markup_decide_where_the_text_is_silent(spark, docs):
    pages = spark.read.parquet(f"{SF}/pages.parquet").where("url LIKE '%/de/%'").select("html").limit(1).first()["html"]
    rows = [(i, f"https://host.example.com/{i}", pages) for i in range(20)] + [(99, "https://host.example.com/x", "<html lang='de'><p>12 34</p>")]
    got = {r["page_id"]: r for r in page_languages(spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()}
    assert got[99]["lang"] == "de" and got[99]["probability"] > 0.5


def test_odd_rows(spark, docs, empty):
    rows = [(1, None, None, "q"), (None, "http://[bad", "<html lang=de>x", "q"), (1, "http://a.b.de/", "", None), (1, "http://a.b.de/", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = page_languages(pages, docs).collect()
    assert len(got) == 4 and all(r["lang"] for r in got)
    assert page_languages(pages.limit(0), docs).count() == 0
    assert {r["lang"] for r in page_languages(pages, empty).collect()} == {None}
