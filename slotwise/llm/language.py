"""Language of web pages by Bayesian evidence fusion.

Four kinds of evidence multiply: the page's text (naive Bayes on hashed byte trigrams, learned from
all documents with a language), the language its markup declares, the suffix of its address, and
what is known of its host. The last three come from the pages themselves: every page adds its text
posterior to the counts of its host, domain, suffix and declaration, and takes its own part out
again before using them. Host counts are smoothed towards the domain's, these towards all pages'.

At scale: html is read once and not shuffled; grouped sums have one row per key and partly add up
before the shuffle, so a host with a third of all pages is a row from each task. The text model is
``BINS`` numbers for each of at most ``most_languages`` languages (the most frequent ones).
"""

from __future__ import annotations

import re
from functools import partial
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slotwise.llm.text import LOWER, slices, text_bytes
from slotwise.session import materialise

BINS = 1 << 14
MOST_LANGUAGES = 100
TEMPER = 0.05  # trigrams overlap and repeat, so each counts for a part only
STRENGTH = 5.0  # pages that a parent's share is worth
SMOOTHING = 0.5

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_HIDDEN = {t: re.compile(f"</{t}\\s*+>", re.I) for t in "script style nav footer aside template noscript".split()}
_TAG = re.compile(r"<(!--|/?[a-z0-9]*)", re.I)
_HTML = re.compile(r"<html\b", re.I)
_LANG = re.compile(r"(?<!\S)lang\s*+=\s*+[\"']?([a-z]{2,3})\b", re.I)
_ENTITY = re.compile(r"&#?\w{1,10};")


def trigrams(buffer: np.ndarray, offsets: np.ndarray):
    """Bin of every byte trigram that holds a letter, and the number of the text it is in."""
    n = int(offsets[-1])
    b = np.where(_LETTER[buffer[:n]], LOWER[buffer[:n]], 0x20).astype(np.uint32)
    if n < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    bins = (b[:-2] * 0x9E3B + b[1:-1] * 0x85EB57 + b[2:] * 0x27D4EB2F) >> 7 & (BINS - 1)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    good = (text[:-2] == text[2:]) & (b[1:-1] != 0x20)
    return bins[good].astype(np.int64), text[:-2][good]


def _count(batches, languages: list[str]):
    place = {name: i for i, name in enumerate(languages)}
    total = np.zeros(len(languages) * BINS, np.int64)
    for batch in batches:
        for piece in slices(batch, "text"):
            bins, text = trigrams(*text_bytes(piece.column("text")))
            of = np.array([place[x] for x in piece.column("lang").to_pylist()], np.int64)
            total += np.bincount(of[text] * BINS + bins, minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["at", "n"])


def train(docs: DataFrame, most_languages: int = MOST_LANGUAGES) -> dict:
    """Languages and the log probability of each trigram bin in each; null texts and languages are left out."""
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    top = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    languages = sorted(r["lang"] for r in top)
    counts = np.zeros(len(languages) * BINS)
    if languages:
        counted = rows.where(F.col("lang").isin(languages)).mapInArrow(partial(_count, languages=languages), "at long, n long")
        found = counted.groupBy("at").agg(F.sum("n").alias("n")).toPandas()  # at most languages * BINS rows
        counts[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
    counts = counts.reshape(len(languages), BINS) + SMOOTHING
    return {"languages": languages, "log_p": np.log(counts / counts.sum(axis=1, keepdims=True)) if languages else counts}


def address(url: str | None) -> tuple[str, str, str]:
    """Host, domain (its last two labels) and suffix (its last label); empty where there is none."""
    try:
        host = (urlsplit(url or "").hostname or "").strip(".")
    except ValueError:
        host = ""
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1] if len(labels) > 1 and not labels[-1].isdigit() else ""


def declared(html: str | None) -> str:
    """The language that an html tag declares; the first that does."""
    html = html or ""
    for tag in _HTML.finditer(html):
        end = html.find(">", tag.end())
        found = _LANG.search(html, tag.end(), end if end >= 0 else len(html))
        if found:
            return found[1].lower()
        if end < 0:
            break
    return ""


def visible(html: str | None) -> str:
    """Text of a page without markup, scripts, navigation and entities, in one pass forward."""
    html, at, out = html or "", 0, []
    never: set = set()  # marks that do not come any more

    def after(mark: str | re.Pattern, begin: int) -> int:
        if mark in never:
            return -1
        if isinstance(mark, str):
            found = html.find(mark, begin)
            end = found + len(mark) if found >= 0 else -1
        else:
            found = mark.search(html, begin)
            end = found.end() if found else -1
        if end < 0:
            never.add(mark)
        return end

    while (tag := _TAG.search(html, at)) and (end := after(">", tag.end())) >= 0:
        out.append(html[at : tag.start()])
        name = tag[1].lower()
        closer = after("-->", tag.end()) if name == "!--" else after(_HIDDEN[name], tag.end()) if name in _HIDDEN else -1
        at = closer if closer >= 0 else end
    out.append(html[at:])
    return _ENTITY.sub(" ", " ".join(out))


_EVIDENCE = "page_id long, host string, domain string, suffix string, declared string, trigrams long, q array<double>"


def _evidence(batches, model: dict):
    k, log_p = len(model["languages"]), model["log_p"]
    for batch in batches:
        for piece in slices(batch, "html"):
            html = piece.column("html").to_pylist()
            buffer, offsets = text_bytes(pa.array([visible(h) for h in html], pa.large_string()))
            bins, text = trigrams(buffer, offsets)
            count = np.bincount(text, minlength=len(html))
            score = np.stack([np.bincount(text, row[bins], len(html)) for row in log_p], axis=1) * TEMPER if k else np.zeros((len(html), 0))
            q = np.exp(score - score.max(axis=1, keepdims=True)) if k else score
            q = q / q.sum(axis=1, keepdims=True) if k else q
            parts = [address(u) for u in piece.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("page_id"), *(pa.array([p[i] for p in parts], pa.string()) for i in range(3)),
                    pa.array([declared(h) for h in html], pa.string()), pa.array(count.astype(np.int64)), pa.array(q.tolist(), pa.list_(pa.float64())),
                ],
                ["page_id", "host", "domain", "suffix", "declared", "trigrams", "q"],
            )


def page_languages(pages: DataFrame, docs: DataFrame, most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """``page_id, lang, probability, text_lang, declared, suffix, host, posterior``, a row per input row.

    ``posterior`` lists the probabilities of all languages in the order of their names; ties go to
    the first. Null or empty html: flat text evidence. Null or broken url: no host, so all such
    pages share one. Repeated rows count each. Other columns are ignored. Without documents that
    have a language: null language and probability.
    """
    return fuse(pages, train(docs, most_languages))


def fuse(pages: DataFrame, model: dict) -> DataFrame:
    names = model["languages"]
    k = len(names)
    raw = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = materialise(raw.mapInArrow(partial(_evidence, model=model), _EVIDENCE), "page-evidence")
    if not k:
        none = F.lit(None).cast("string")
        return rows.select("page_id", none.alias("lang"), F.lit(None).cast("double").alias("probability"), none.alias("text_lang"), "declared", "suffix", "host", F.col("q").alias("posterior"))

    def sums(name: str) -> list:
        # informed pages only; whole millionths, so that sums do not depend on their order
        return [F.sum(F.round(F.when(F.col("trigrams") > 0, F.col("q")[i]).otherwise(0.0) * 1e6).cast("long")).alias(f"{name}{i}") for i in range(k)]

    every = rows.agg(*sums("all")).first()
    total = [float(x or 0) / 1e6 for x in every]
    joined = rows
    for key, name in (("host", "h"), ("domain", "d"), ("suffix", "s"), ("declared", "m")):
        joined = joined.join(rows.groupBy(key).agg(*sums(name)), key)
    own = [F.round(F.when(F.col("trigrams") > 0, F.col("q")[i]).otherwise(0.0) * 1e6) / 1e6 for i in range(k)]
    others = lambda name, i: F.greatest(F.col(f"{name}{i}") / 1e6 - own[i], F.lit(0.0))
    overall = [F.greatest(F.lit(total[i]) - own[i], F.lit(0.0)) + SMOOTHING for i in range(k)]

    def plus(columns):
        out = columns[0]
        for c in columns[1:]:
            out = out + c
        return out

    wide = joined.select("page_id", "host", "suffix", "declared", "q", *(c.alias(f"o{i}") for i, c in enumerate(overall)), *(others(n, i).alias(f"{n}{i}") for n in "hdsm" for i in range(k)))
    share = [F.col(f"o{i}") / plus([F.col(f"o{j}") for j in range(k)]) for i in range(k)]
    wide = wide.select("*", *(c.alias(f"g{i}") for i, c in enumerate(share)))
    for name, parent, out in (("d", "g", "x"), ("h", "x", "y")):
        count = plus([F.col(f"{name}{j}") for j in range(k)])
        wide = wide.select("*", *(((F.col(f"{name}{i}") + STRENGTH * F.col(f"{parent}{i}")) / (count + STRENGTH)).alias(f"{out}{i}") for i in range(k)))
    # P(suffix | language) and P(declared | language), up to a factor that is the same for all
    seen = lambda name, i: F.log((F.col(f"{name}{i}") + SMOOTHING) / (F.col(f"o{i}") + 2 * SMOOTHING))
    logs = [F.log(F.greatest(F.col("q")[i], F.lit(1e-300))) + F.log(f"y{i}") + seen("s", i) + F.when(F.col("declared") != "", seen("m", i)).otherwise(0.0) for i in range(k)]
    wide = wide.select("page_id", "host", "suffix", "declared", "q", F.array(*logs).alias("l"))
    wide = wide.withColumn("e", F.transform("l", lambda x: F.exp(x - F.array_max("l"))))
    posterior = F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda a, b: a + b))
    labels = F.array(*(F.lit(n) for n in names))
    best = lambda c: labels[F.array_position(c, F.array_max(c)).cast("int") - 1]
    wide = wide.withColumn("posterior", posterior)
    return wide.select(
        "page_id", best(F.col("posterior")).alias("lang"), F.array_max("posterior").alias("probability"), best(F.col("q")).alias("text_lang"), "declared", "suffix", "host", "posterior"
    )
