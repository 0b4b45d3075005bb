"""Near copies of whole documents: the links of ``simhash``, and beyond them a cosine of 0.8 or more of five-word shingles.

Method: first come the fingerprints of ``simhash`` with its whole search: pigeonring lookups by a segment and half of the
next, chains, Hamming check, components; it loses no link within 4 of 64 bits. The wider search goes on from its groups.

There a text's fingerprint has 512 bits, each the sign of a sum over its distinct shingles, so two texts
differ in a bit with probability acos(cosine) / pi: at a cosine of 0.8 (0.67 of the shingles of both, if they are as
long) in 104 bits. Fingerprints link at 104 differing bits or fewer. Pigeonring filtering comes before the Hamming
check: cut into eight segments on a ring, fingerprints that near have a chain of consecutive segments whose
differences stay within the budget of each of its beginnings; a pair without such a chain of two is passed over.

At that distance equal segments name no candidates, so for what the pigeonring lookups leave MinHash bands do: 40 bands of
5 minima, with which a pair at the limit meets with probability 0.997. The distance decides, not the band.

At scale: texts never move; a text is its two fingerprints and 40 keys, equal shingle sets are one row before the search.
Bands are looked up in three rounds; only fingerprints of a key that holds several groups of the rounds before move
again, so a large group costs a few rows a member. The fingerprints of a key give a forest of links, never their
pairs: members are reached from members already reached, each compared with those still unreached. A key with more
than ``chunk`` of them is dealt out as pairs of chunks, so no task holds more than two chunks and no link is lost.
"""

from __future__ import annotations

from functools import partial
from math import acos, pi

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from slotwise.llm.components import components
from slotwise.llm.frames import key_and_text, shuffle_parts
from slotwise.llm.simhash import fingerprint, near_links, pick_rows
from slotwise.llm.text import LOWER, U64, mixed, slices, span_hashes, text_bytes, window_hashes, word_spans
from slotwise.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
LANES = 8  # of 64 bits
BANDS, ROWS = 40, 5
ROUNDS = ((0, 8), (8, 24), (24, 40))  # bands looked up together
BASE = 0x5851F42D4C957F2D
CHUNK = 4096
SMALL_GROUP = 8
_TURNS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=U64)) | U64(1)
_LANES = mixed(np.arange(1001, 1001 + LANES, dtype=U64)) | U64(1)
_PART = 1 << 13


def distance_at(similarity: float, bits: int = 64 * LANES) -> int:
    """How many bits two texts of that cosine differ in."""
    return int(bits * acos(similarity) / pi)


def shingle_hashes(column: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, repeats included, and how many lie before each text (n + 1).

    Words are runs of bytes other than space and 0x09-0x0D with A-Z lowered. Fewer than ``shingle``
    words make one shingle, none make none.
    """
    buffer, offsets = text_bytes(column)
    buffer = LOWER[buffer]
    begin, end, first = word_spans(buffer, offsets)
    words, count = span_hashes(buffer, begin, end), np.diff(first)
    windows = mixed(window_hashes(words, shingle, BASE))
    room = np.where(count >= shingle, count - shingle + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(room)])
    place = np.repeat(first[:-1] - at[:-1], room) + np.arange(at[-1])
    out = np.zeros(at[-1], U64)
    whole = np.repeat(count >= shingle, room)
    out[whole] = windows[place[whole]]
    for i in np.flatnonzero((count > 0) & (count < shingle)):
        out[at[i]] = xxhash.xxh64_intdigest(words[first[i] : first[i + 1]].tobytes())
    return out, at


def fingerprint_of(shingles: np.ndarray) -> np.ndarray:
    """The bits of a set of shingle hashes, as ``LANES`` numbers; zeros for none."""
    counts = np.zeros((LANES, 64), np.int64)
    for a in range(0, len(shingles), _PART):
        part = shingles[a : a + _PART]
        for lane, turn in enumerate(_LANES):
            bits = np.unpackbits(mixed(part * turn).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts[lane] += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(shingles), axis=1, bitorder="little").view(U64).ravel()


def _signatures(batches, shingle: int):
    for batch in batches:
        for piece in slices(batch, "text"):
            h, at = shingle_hashes(piece.column("text"), shingle)
            some = np.flatnonzero(np.diff(at))
            keys = np.empty((len(some), BANDS), U64)
            for band in range(BANDS if len(some) else 0):
                key = np.full(len(some), U64(band))
                for turn in _TURNS[band * ROWS : (band + 1) * ROWS]:
                    key = mixed(key ^ np.minimum.reduceat(h * turn, at[some])) + turn
                keys[:, band] = key
            sets = [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:])]
            number = np.full(len(sets), -1)
            number[some] = np.arange(len(some))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("text_hash"),
                    pa.array(np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], U64).view(np.int64)),
                    pa.array([fingerprint_of(s).tobytes() for s in sets], pa.binary()),
                    pa.array([keys[i].view(np.int64) if i >= 0 else [] for i in number], pa.list_(pa.int64())),
                    pa.array(np.array([fingerprint(t.as_py()) for t in piece.column("text")], U64).view(np.int64)),
                ],
                ["doc_id", "text_hash", "kind", "fp", "bands", "close"],
            )


def _near(differences: np.ndarray, distance: int) -> np.ndarray:
    """Which rows of differing bits are within ``distance``: first a chain of two segments, then all of them."""
    bits = np.bitwise_count(differences).astype(np.int64)
    two = bits + np.roll(bits, -1, axis=1)
    near = ((bits * LANES <= distance) & (two * LANES <= 2 * distance)).any(axis=1)
    near[near] = bits[near].sum(axis=1) <= distance
    return near


def _forest(fp: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Links that join the members of one group into the components of all its links."""
    left, right, open_ = [], [], np.arange(len(fp))
    while len(open_):
        queue, open_ = [int(open_[0])], open_[1:]
        while queue and len(open_):
            i = queue.pop()
            near = _near(fp[open_] ^ fp[i], distance)
            if near.any():
                found = open_[near]
                left += found.tolist()
                right += [i] * len(found)
                queue += found.tolist()
                open_ = open_[~near]
    return left, right


def _links(batches, distance: int):
    """Links within the groups of a partition sorted by (key, left, right)."""

    def of(key, left, right, kind, fp):
        cut = np.flatnonzero((np.diff(key) != 0) | (np.diff(left) != 0) | (np.diff(right) != 0)) + 1
        begin = np.concatenate([[0], cut])
        size = np.diff(np.append(begin, len(key)))
        place = np.arange(len(key)) - np.repeat(begin, size)
        room = np.repeat(np.where(size <= SMALL_GROUP, size, 0), size)
        out = []
        for lag in range(1, SMALL_GROUP):
            i = np.flatnonzero(place + lag < room)
            for some in np.array_split(i, len(i) // 65536 + 1):
                live = some[_near(fp[some] ^ fp[some + lag], distance)]
                out.append((kind[live], kind[live + lag]))
        for b, n in zip(begin[size > SMALL_GROUP].tolist(), size[size > SMALL_GROUP].tolist()):
            one, two = _forest(fp[b : b + n], distance)
            out.append((kind[b : b + n][one], kind[b : b + n][two]))
        a, b = (np.concatenate([o[k] for o in out]) for k in (0, 1))
        keep = a != b
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)[keep]), pa.array(np.minimum(a, b)[keep])], ["a", "b"])

    held = None
    for batch in batches:
        fp = np.frombuffer(b"".join(batch.column("fp").to_pylist()), U64).reshape(-1, LANES)
        new = [*(batch.column(c).to_numpy() for c in ("key", "left", "right", "kind")), fp]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        if not len(held[0]):
            continue
        last = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1])
        at = len(last) - int(np.count_nonzero(last))
        if at:
            yield of(*(x[:at] for x in held))
            held = [x[at:] for x in held]
    if held is not None and len(held[0]):
        yield of(*held)


def _dealt(rows: DataFrame, kinds: DataFrame, chunk: int) -> DataFrame:
    """Fingerprints of the keys that hold more than one label; a key of several chunks as pairs of chunks."""
    held = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("one"), F.max("label").alias("two"))
    parts = held.where("one <> two").select("key", F.ceil(F.col("n") / chunk).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("kind"), F.col("parts")).cast("int")
    dealt = rows.join(parts, "key").select("key", "kind", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    dealt = dealt.select("key", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"), "kind")
    return dealt.join(kinds.select("kind", "fp"), "kind")


def close_links(made: DataFrame) -> DataFrame:
    """Links ``a, b`` that join the kinds of texts whose ``simhash`` fingerprints ``close`` are of one component: a star each."""
    pairs = materialise(made.select("kind", "close").distinct(), "close")
    roots = components(near_links(pairs.select(F.col("close").alias("fp")).distinct()))
    rooted = pairs.join(roots.withColumnRenamed("v", "close"), "close", "left").select("kind", F.coalesce("root", "close").alias("root"))
    least = rooted.groupBy("root").agg(F.min("kind").alias("b"))
    return rooted.join(least, "root").where("kind <> b").select(F.col("kind").alias("a"), "b")


def similar_roots(kinds: DataFrame, distance: int, chunk: int = CHUNK, *, links: DataFrame | None = None) -> DataFrame | None:
    """``v, root``: ``kinds`` (kind, fp, bands) joined into the components of ``links`` and of all fingerprints that share
    a band and lie within ``distance``; kinds without a link, or their own root, have no row."""
    roots = None if links is None or links.isEmpty() else materialise(components(links), "roots")
    for first, last in ROUNDS:
        rows = kinds.select("kind", F.explode(F.slice("bands", first + 1, last - first)).alias("key"))
        if roots is None:
            rows = rows.withColumn("label", F.col("kind"))
        else:
            rows = rows.join(roots.withColumnRenamed("v", "kind"), "kind", "left").select("kind", "key", F.coalesce("root", "kind").alias("label"))
        dealt = _dealt(rows, kinds, chunk).select("key", "left", "right", "kind", "fp")
        dealt = dealt.repartition(shuffle_parts(dealt), "key", "left", "right").sortWithinPartitions("key", "left", "right", "kind")
        found = materialise(dealt.mapInArrow(partial(_links, distance=distance), "a long, b long"), "near-links")
        links = found if links is None else links.unionByName(found)
        if not found.isEmpty():
            roots = materialise(components(links), "roots")
    return roots


def similar_groups(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, text_hash, group`` for every row of ``docs``: rows of one group are joined by near fingerprints, those of
    ``simhash`` or the wider ones.

    Texts without words are alike. Null text counts as empty, a null doc_id is larger than all others. Repeated rows
    are one text, and get a row each. An empty table gives no rows.
    """
    keyed = key_and_text(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    made = keyed.mapInArrow(partial(_signatures, shingle=shingle), "doc_id long, text_hash long, kind long, fp binary, bands array<long>, close long")
    made = materialise(made, "signatures")
    kinds = materialise(made.groupBy("kind").agg(F.min("fp").alias("fp"), F.min("bands").alias("bands")), "kinds")
    roots = similar_roots(kinds, distance_at(similarity), links=materialise(close_links(made), "close-links"))
    rows = made.select("doc_id", "text_hash", "kind")
    if roots is None:
        return rows.withColumnRenamed("kind", "group")
    rows = rows.join(roots.withColumnRenamed("v", "kind"), "kind", "left")
    return rows.select("doc_id", "text_hash", F.coalesce("root", "kind").alias("group"))


def keep_one_of_similar(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` with one document of every group: the smallest doc_id, then the smallest text hash; of equal rows, one."""
    groups = similar_groups(docs, **settings)
    chosen = groups.groupBy("group").agg(F.min(F.struct("doc_id", "text_hash")).alias("who")).select("who.doc_id", "who.text_hash")
    return pick_rows(docs, chosen)
