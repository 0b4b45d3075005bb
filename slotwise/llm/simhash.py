"""Near copies by SimHash fingerprints within a few differing bits.

Method: pigeonring filtering. A 64-bit fingerprint is cut into five segments on a ring. If two
fingerprints differ in at most 4 bits, some chain of consecutive segments keeps every prefix of
length l within l * 4 / 5 differences: none in its first segment, at most 1 in the first two,
2 in three, 3 in four. So pairs are looked up by an equal segment and an equal half of the next
one; chains are then followed step by step, and only what is left gets the full Hamming check.

At scale: equal fingerprints are one row before the search. Each looked-up group gives at most
a spanning forest of links (never its pairs); a group above ``chunk`` members is dealt out as
pairs of chunks, so no task holds more than two chunks and no link is lost. Components follow
from the links by rounds of joins.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from slotwise.llm.components import components
from slotwise.llm.frames import BIGGEST, fresh, key_and_text, shuffle_parts
from slotwise.llm.text import LOWER_BYTES
from slotwise.session import materialise

SHINGLE = 4
SEED = 42
DISTANCE = 4
WIDTHS = (13, 13, 13, 13, 12)
STARTS = tuple(int(x) for x in np.cumsum((0,) + WIDTHS[:-1]))
CHUNK = 4096
SMALL_GROUP = 32


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of a text; zero if it has no words."""
    words = (text or "").encode().translate(LOWER_BYTES).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        begins, ends = begins[: 1 - shingle], ends[shingle - 1 :]
    else:
        begins, ends = begins[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(begins)
    for at in range(0, n, 1 << 16):
        pairs = zip(begins[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist())
        h = np.array([digest(joined[a:b], seed) for a, b in pairs], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches, shingle: int, seed: int):
    for batch in batches:
        fp = [fingerprint(t.as_py(), shingle, seed) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(np.array(fp, np.uint64).view(np.int64))], ["doc_id", "text_hash", "fp"]
        )


def _segment(fp, i: int):
    return F.shiftrightunsigned(fp, STARTS[i]).bitwiseAND(F.lit((1 << WIDTHS[i]) - 1))


def lookups(fingerprints: DataFrame) -> DataFrame:
    """``key, fp``: ten keys of each fingerprint, one per segment and half of the next segment."""
    fp, keys = F.col("fp"), []
    for i in range(5):
        half = (WIDTHS[(i + 1) % 5] + 1) // 2
        following = _segment(fp, (i + 1) % 5)
        for j in (0, 1):
            part = F.shiftrightunsigned(following, half) if j else following.bitwiseAND(F.lit((1 << half) - 1))
            keys.append(F.lit(2 * i + j).cast("long") * (1 << 32) + _segment(fp, i) * (1 << 16) + part)
    return fingerprints.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _chain_masks(distance: int) -> list[list[tuple[np.uint64, int]]]:
    """For each first segment: the bits of the chain's prefixes and how many may differ in them."""
    out = []
    for i in range(5):
        bits, steps = 0, []
        for length in range(1, 6):
            s = (i + length - 1) % 5
            bits |= ((1 << WIDTHS[s]) - 1) << STARTS[s]
            steps.append((np.uint64(bits), length * distance // 5))
        out.append(steps)
    return out


def _near(a: np.ndarray, b: np.ndarray, first: np.ndarray, distance: int) -> np.ndarray:
    """Numbers of the pairs that pass their chains, the last of which is the full Hamming check."""
    masks = _chain_masks(distance)
    live = np.arange(len(a))
    for step in range(1, 5):
        mask = np.array([m[step][0] for m in masks], np.uint64)[first[live]]
        live = live[np.bitwise_count((a[live] ^ b[live]) & mask) <= masks[0][step][1]]
    return live


def _forest(fp: np.ndarray, first: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of one large group; memory stays at 256 rows of its distance matrix."""
    chain = _chain_masks(distance)[first]
    label = np.arange(len(fp))
    for at in range(0, len(fp), 256):
        x = fp[at : at + 256, None] ^ fp[None, :]
        hit = np.bitwise_count(x & chain[1][0]) <= chain[1][1]
        for mask, most in chain[2:]:
            hit[hit] = np.bitwise_count(x[hit] & mask) <= most
        for r in range(hit.shape[0]):
            found = np.unique(label[hit[r]])
            if len(found) > 1:
                label[np.isin(label, found)] = found[0]
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def _links(batches, distance: int):
    """Links within the groups of a partition sorted by (key, left, right)."""

    def of(key, left, right, fp):
        cut = np.flatnonzero((np.diff(key) != 0) | (np.diff(left) != 0) | (np.diff(right) != 0)) + 1
        begin = np.concatenate([[0], cut])
        size = np.diff(np.append(begin, len(key)))
        first = (key >> 33).astype(np.int64)
        place = np.arange(len(key)) - np.repeat(begin, size)
        room = np.repeat(np.where(size <= SMALL_GROUP, size, 0), size)
        out = []
        for lag in range(1, SMALL_GROUP):
            i = np.flatnonzero(place + lag < room)
            if not len(i):
                break
            live = i[_near(fp[i], fp[i + lag], first[i], distance)]
            out.append((fp[live], fp[live + lag]))
        for b, n in zip(begin[size > SMALL_GROUP].tolist(), size[size > SMALL_GROUP].tolist()):
            out.append(_forest(fp[b : b + n], int(first[b]), distance))
        a, b = (np.concatenate([o[k] for o in out] or [np.empty(0, np.uint64)]).view(np.int64) for k in (0, 1))
        keep = a != b
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)[keep]), pa.array(np.minimum(a, b)[keep])], ["a", "b"])

    held = None
    for batch in batches:
        new = [batch.column(c).to_numpy() for c in ("key", "left", "right", "fp")]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        if not len(held[0]):
            continue
        last = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1])
        at = len(last) - int(np.count_nonzero(last))
        if at:
            yield of(*(x[:at] for x in held[:3]), held[3][:at].view(np.uint64))
            held = [x[at:] for x in held]
    if held is not None and len(held[0]):
        yield of(*held[:3], held[3].view(np.uint64))


def near_links(fingerprints: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Pairs ``a, b`` (a > b) that join the distinct fingerprints ``fp`` into the same components
    as all links within ``distance`` bits do: small groups give their links, large ones a forest.

    ``distance`` up to 4: the keys rest on an equal first segment and one difference in the next.
    """
    if not 0 <= distance <= 4:
        raise ValueError("distance must be between 0 and 4")
    rows = lookups(fingerprints)
    large = materialise(rows.groupBy("key").count().where(F.col("count") > chunk).withColumn("n", F.ceil(F.col("count") / chunk)), "large-keys")
    whole = rows.select("key", F.lit(0).alias("left"), F.lit(0).alias("right"), "fp")
    if not large.isEmpty():
        part = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
        other = F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")))
        dealt = rows.join(large.select("key", "n"), "key").select("key", "fp", part.alias("part"), other.alias("other"))
        dealt = dealt.select("key", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"), "fp")
        whole = whole.join(large.select("key"), "key", "left_anti").unionByName(dealt)
    whole = whole.repartition(shuffle_parts(whole), "key", "left", "right").sortWithinPartitions("key", "left", "right", "fp")
    return whole.mapInArrow(partial(_links, distance=distance), "a long, b long")


def simhash_groups(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, text_hash, fp, component_id`` for every row of ``docs``.

    Words are runs of bytes other than space and 0x09-0x0D with A-Z lowered; features are the
    ``shingle``-word sequences, repeats included; fewer words make one feature, none the
    fingerprint zero, which is linked like any other. ``component_id`` is the smallest doc_id
    that links reach, itself included.

    Null text counts as empty. A null doc_id is larger than all others. Repeated rows and
    repeated doc_ids give one row each. Other columns are ignored. Empty table: empty result.
    """
    keyed = key_and_text(docs)
    hashed = keyed.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    made = hashed.select("doc_id", "text_hash", "text").mapInArrow(
        partial(_fingerprints, shingle=shingle, seed=seed), "doc_id long, text_hash long, fp long"
    )
    made = materialise(made, "fingerprints")
    kinds = materialise(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "kinds")
    roots = components(near_links(kinds.select("fp"), distance))
    rooted = kinds.join(roots.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_kind = rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return made.join(of_kind, "fp")


def keep_one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` with one document of every group of near copies: the smallest doc_id.

    Of rows that share it, the one whose text has the smallest hash stays; of equal rows, one.
    """
    groups = simhash_groups(docs, **settings)
    return pick_rows(docs, groups.where("doc_id = component_id").groupBy("doc_id").agg(F.min("text_hash").alias("text_hash")))


def pick_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` and ``text_hash`` are ``chosen``; of equal rows, one."""
    key, hashed, number = fresh(docs, "_id", "_hash", "_n")
    chosen = chosen.select(F.col("doc_id").alias(key), F.col("text_hash").alias(hashed))
    marked = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(BIGGEST))).withColumn(hashed, F.xxhash64(F.col("text").cast("string")))
    kept = marked.join(materialise(chosen, "kept"), [key, hashed])
    one = Window.partitionBy(key, hashed).orderBy(*(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")), key)
    return kept.withColumn(number, F.row_number().over(one)).where(F.col(number) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))
