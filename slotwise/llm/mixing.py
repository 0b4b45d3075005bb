"""Mixing sources to target weights by balanced sampling.

Method: every source gets a target; what exceeds whole passes over the source is an inclusion
probability for its documents. The cube method moves these probabilities through the null space
of two constraints (number of documents, number of words) until they are 0 or 1, so both totals
keep their expectations. Flights run in blocks of a source; each leaves at most two documents
undecided, and those of all blocks fly again, until a single block per source is left. Its last
documents, at most two, land with the constraint on words dropped.

Rows equal in every column are one unit of n copies: of its n * p expected copies the whole ones are taken, and what is
left is the probability of one more, so however many rows repeat each other, a draw never moves more than one document.

At scale: only (doc_id, source, size, hash of the row) moves; a source with a third of all rows is many blocks.
"""

from __future__ import annotations

import random
import zlib
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from slotwise.llm.frames import BIGGEST, fresh, original_id
from slotwise.session import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BLOCK = 10_000
NOT_SPACE = "[^\\x20\\x09-\\x0D]+"

UNIT = "source string, doc_id long, size long, row long, copies long, whole long, start double, p double"


def words_in(text):
    """Number of runs of characters other than space and 0x09-0x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size, copies``.

    Sources in code point order, null last, take ``weights`` in turn and share ``share`` times
    all sizes. With caps of ``most`` times a source's size, sources reach their caps in order of
    cap / weight, so running sums in that order give the level at which the rest share.
    One row per source is handled here, whatever the number of documents.
    """
    by_source = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = F.array(*(F.lit(float(w)) for w in weights))
    ranked = by_source.withColumn("w", turn[F.pmod(rank - 1, F.lit(len(weights)))]).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("w"), "w", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    shared = ranked.withColumn("level", level).withColumn("open", F.col("cap") > F.col("w") * F.col("level"))
    common = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    first_open = F.min(F.when(F.col("open"), F.col("cap") / F.col("w"))).over(every)
    full = first_open.isNull() | (F.col("cap") / F.col("w") < first_open)
    return shared.select("source", "source_size", F.when(full, F.col("cap")).otherwise(F.col("w") * common).alias("target"))


def _direction(units: list[list[float]]) -> list[float] | None:
    """A vector u with sum(a * u) = 0 in both constraints, for two or three units (a1, a2)."""
    if len(units) == 3:
        (a, d), (b, e), (c, f) = units
        u = [b * f - c * e, c * d - a * f, a * e - b * d]
        if max(map(abs, u)) > 1e-9 * max(abs(x) for unit in units for x in unit) ** 2:
            return u
    for i in range(len(units)):
        for j in range(i + 1, len(units)):
            (a, d), (b, e) = units[i], units[j]
            if abs(a * e - b * d) <= 1e-12 * max(abs(a * e), abs(b * d), 1e-300):
                u = [0.0] * len(units)
                u[i], u[j] = (b, -a) if a or b else (e, -d)
                return u if any(u) else None
    return None


def _step(p: list[float], u: list[float], draw: float) -> list[float]:
    """Move ``p`` along ``u`` or against it to a face of the cube, keeping its expectation."""
    ahead = min((1 - x) / v if v > 0 else x / -v for x, v in zip(p, u) if v)
    back = min(x / v if v > 0 else (1 - x) / -v for x, v in zip(p, u) if v)
    move = ahead if draw * (ahead + back) < back else -back
    moved = [x + move * v for x, v in zip(p, u)]
    return [0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x for x in moved]


def fly(sizes, copies, start, p, rng: random.Random, land: bool) -> list[float]:
    """Probabilities after the flight over one block; with ``land`` all are 0 or 1."""
    p = list(p)
    rows = [(c / s, c * z / s) if s else (0.0, 0.0) for z, c, s in zip(sizes, copies, start)]
    live = []
    for i in range(len(p)):
        if not 0 < p[i] < 1:
            continue
        live.append(i)
        while len(live) > 1:
            u = _direction([list(rows[k]) for k in live])
            if u is None:
                break
            for k, x in zip(live, _step([p[k] for k in live], u, rng.random())):
                p[k] = x
            live = [k for k in live if 0 < p[k] < 1]
    if land:
        while len(live) > 1:
            (i, j), (a, b) = live[:2], (rows[live[0]][0], rows[live[1]][0])
            p[i], p[j] = _step([p[i], p[j]], [b, -a], rng.random())
            live = [k for k in live if 0 < p[k] < 1]
        for k in live:
            p[k] = 1.0 if rng.random() < p[k] else 0.0
    return p


def _fly_group(pdf: pd.DataFrame, seed: int, turn: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["mixed", "doc_id", "size", "row"], kind="stable")
    head = pdf.iloc[0]
    rng = random.Random(zlib.crc32(f"{seed} {turn} {head['source']!r} {head['block']}".encode()))
    last = bool(head["blocks"] == 1)
    done = fly(pdf["size"].tolist(), [1] * len(pdf), pdf["start"].tolist(), pdf["p"].tolist(), rng, last)
    return pdf.assign(p=done)[["source", "doc_id", "size", "row", "copies", "whole", "start", "p"]]


def balanced_sample(units: DataFrame, block: int = BLOCK, seed: int = 42) -> DataFrame:
    """``units`` (source, doc_id, size, row, copies, whole, start, p) with every ``p`` moved to 0 or 1."""
    settled, turn = None, 0
    while True:
        count = units.where("p > 0 AND p < 1").groupBy("source").agg(F.ceil(F.count("*") / block).alias("blocks"))
        mixed = F.xxhash64(F.lit(seed), F.lit(turn), "doc_id", "size", "row")
        dealt = units.where("p > 0 AND p < 1").alias("u").join(count.alias("c"), F.expr("u.source <=> c.source")).select("u.*", "c.blocks")
        dealt = dealt.withColumn("mixed", mixed).withColumn("block", F.pmod("mixed", "blocks"))
        flown = dealt.groupBy("source", "block").applyInPandas(partial(_fly_group, seed=seed, turn=turn), UNIT)
        flown = materialise(flown, "flight")
        decided = units.where("p <= 0 OR p >= 1").unionByName(flown.where("p <= 0 OR p >= 1"))
        settled = decided if settled is None else settled.unionByName(decided)
        units, turn = flown.where("p > 0 AND p < 1"), turn + 1
        if units.isEmpty():
            return settled


def _row_hash(docs: DataFrame):
    """A hash of all columns that can be hashed; maps and variants cannot."""
    plain = [f.name for f in docs.schema if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    return F.xxhash64(*(F.col(f"`{c}`") for c in plain))


def drawn_units(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK, seed: int = 42) -> DataFrame:
    """``doc_id, source, size, row, copies, source_size, target, passes, more``: equal rows are one line; each of its
    copies is taken ``passes`` times, and ``more`` of them once again."""
    sized = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(BIGGEST)).alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        words_in(F.col("text").cast("string")).alias("size"),
        _row_hash(docs).alias("row"),
    )
    sized = materialise(sized.groupBy("source", "doc_id", "size", "row").agg(F.count("*").alias("copies")), "sizes")
    targets = materialise(source_targets(sized, weights, share, most), "targets")
    ratio = F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(F.lit(0.0))
    expected = F.col("copies") * (ratio - F.floor(ratio))
    units = sized.alias("s").join(targets.alias("t"), F.expr("s.source <=> t.source"))
    units = units.select("s.*", F.floor(expected).alias("whole"), (expected - F.floor(expected)).alias("start")).withColumn("p", F.col("start"))
    drawn = balanced_sample(units, block, seed).alias("d").join(targets.alias("t"), F.expr("d.source <=> t.source"))
    more = (F.col("d.whole") + F.col("d.p").cast("long")).alias("more")
    return drawn.select("d.doc_id", "d.source", "d.size", "d.row", "d.copies", "t.source_size", "t.target", F.floor(ratio).alias("passes"), more)


def mix(docs: DataFrame, **settings) -> DataFrame:
    """What the mix takes: ``doc_id, source, size, source_size, target, times``, a row per input row.

    ``size`` is the number of words, ``times`` how often the document is taken (whole passes of
    its source plus the balanced sample). Same input, same result, however it is partitioned.

    Null or empty text: size 0. Null source: a source of its own, last. Null doc_id: last, one id.
    Rows that share an id are drawn one by one. Empty table: empty result. Other columns only tell
    rows apart. Settings: weights, share, most, block, seed.
    """
    rows = drawn_units(docs, **settings).select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    times = F.col("passes") + F.when(F.col("copy") <= F.col("more"), 1).otherwise(0)
    return rows.select(original_id(), "source", "size", "source_size", "target", times.alias("times"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix` takes it."""
    units = materialise(drawn_units(docs, **settings).where("passes > 0 OR more > 0"), "drawn")
    key, row, again = fresh(docs, "_id", "_row", "_again")
    marked = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(BIGGEST))).withColumn(row, _row_hash(docs))
    names = [F.col("doc_id").alias(key), F.col("row").alias(row)]
    each = F.when(F.col("copies") == 1, F.col("passes") + F.col("more")).otherwise(F.col("passes")).alias(again)
    more = units.where("copies > 1 AND more > 0").select(*names, F.col("more").alias(again))
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def repeated(rows: DataFrame) -> DataFrame:
        return rows.withColumn(again, F.explode(F.sequence(F.lit(1).cast("long"), F.col(again)))).select(*columns)

    # The drawn units have no proven bound: the same join at every size, never a broadcast.
    rows = repeated(marked.join(units.select(*names, each).where(F.col(again) > 0).hint("merge"), [key, row]))
    return rows.unionByName(repeated(marked.join(more, [key, row]).dropDuplicates([key, row])))
