"""Removal of word sequences that occurred before.

Method: the Rabin-Karp hash of every window of ``window`` words is counted in Spark. A task
hashes the windows of its documents with numpy, keeps the first of each hash, and sends the
hashes to the bucket that a second, independent hash names, as packed arrays with document
and start. Each bucket finds the first place of every hash; all other places go back, packed by
the part of the documents they belong to, and are sorted out there: overlapping windows merge
into maximal intervals, which are cut out.

At scale: a window moves once as about nine bytes, a document's text once; a sequence that a
third of all rows holds is one entry per block of a task. Equality of windows is equality of 56
bits of Rabin-Karp hash and of the bucket, which a second hash chooses among one per 8 MB of text;
so the hash grows with the corpus: 63 bits at 1 GB (a false match is expected once in a thousand
corpora), 80 bits at 100 TB (some hundred false matches among 10^13 windows).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slotwise.llm.frames import key_and_text, original_id, parts_for, shuffle_parts
from slotwise.llm.text import U64, mixed, pack, pack_ids, slices, span_hashes, text_bytes, unpack, unpack_ids, window_hashes, word_spans

WINDOW = 20
BUCKET_MB = 8  # text per bucket
BLOCK = 1_200_000  # windows a task holds before it sends them
# The primes of XXH64.
_XXH = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
BASE, BASE_2 = 0x5851F42D4C957F2D, 0x2545F4914F6CDD1D

SENT = "bucket long, payload binary"
MARKS = "dest long, marks binary"


class _Block:
    """Windows of a task's documents, first of each hash only."""

    def __init__(self, buckets: int, dests: int):
        self.buckets, self.dests, self.size, self.parts = buckets, dests, 0, []

    def add(self, ids, tags, doc, start, h, g):
        self.parts.append((ids, tags, doc, start, h, g))
        self.size += len(h)

    def rows(self) -> Iterator[tuple[int, bytes]]:
        if not self.parts:
            return
        base = np.cumsum([0] + [len(p[0]) for p in self.parts])
        ids, tags = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        doc = np.concatenate([p[2] + b for p, b in zip(self.parts, base)])
        start, h, g = (np.concatenate([p[i] for p in self.parts]) for i in (3, 4, 5))
        self.parts, self.size = [], 0
        by_key = np.lexsort((tags, ids))
        ids, tags = ids[by_key], tags[by_key]
        same = np.zeros(len(ids), bool)
        same[1:] = (ids[1:] == ids[:-1]) & (tags[1:] == tags[:-1])
        rank = np.empty(len(ids), np.int64)
        rank[by_key] = np.cumsum(~same) - 1
        ids, tags = ids[~same], tags[~same]
        doc = rank[doc]
        place = doc.astype(np.int64) << 32 | start
        if len(place) > 1 and (place[1:] < place[:-1]).any():
            order = np.argsort(place, kind="stable")
            doc, start, place, h, g = doc[order], start[order], place[order], h[order], g[order]
        _, first, group = np.unique(h, return_index=True, return_inverse=True)
        late = np.flatnonzero(place != place[first][group])
        d = doc[late]
        for dest, marks in _packed_marks(ids[d], tags[d], start[late], self.dests):
            yield -1 - dest, marks
        del group, place
        first.sort()
        doc, start, h = doc[first], start[first], h[first]
        bucket = ((g[first] >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)
        order = np.argsort(bucket.astype(np.uint32), kind="stable")
        doc, start, h, bucket = doc[order], start[order], h[order], bucket[order]
        for lo, hi in _runs(bucket):
            d = doc[lo:hi]
            cut = np.flatnonzero(np.diff(d, prepend=-1))
            many = np.diff(cut, append=len(d))
            mine = d[cut]
            s = start[lo:hi]
            yield int(bucket[lo]), _joined(_seven(h[lo:hi]), pack_ids(ids[mine]), tags[mine].astype(np.int64).tobytes(), _plain(many), pack(s))


def _seven(h: np.ndarray) -> bytes:
    return h.view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _from_seven(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return out.view(np.uint64).ravel()


def _plain(values: np.ndarray) -> bytes:
    return values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplain(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel().astype(np.int64)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of runs of equal neighbours."""
    if len(values):
        cut = np.flatnonzero(np.diff(values.astype(np.int64))) + 1
        yield from zip([0, *cut.tolist()], [*cut.tolist(), len(values)])


def _joined(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _dest(ids: np.ndarray, dests: int, tags: np.ndarray | None = None) -> np.ndarray:
    """pmod(xxhash64(doc_id), dests), as Spark computes it; with ``tags``, pmod(xxhash64(doc_id, tag), dests)."""
    h = _xxh64(ids, np.full(len(ids), 42, U64))
    return (h if tags is None else _xxh64(tags, h)).view(np.int64) % dests


def _xxh64(values: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """XXH64 of eight bytes each."""
    p1, p2, p3, p4, p5 = (U64(x) for x in _XXH)
    turn = lambda x, k: (x << U64(k)) | (x >> U64(64 - k))
    h = (seed + p5 + U64(8)) ^ turn(values.astype(np.int64).view(U64) * p2, 31) * p1
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> U64(33))) * p2
    h = (h ^ (h >> U64(29))) * p3
    return h ^ (h >> U64(32))


def _packed_marks(ids: np.ndarray, tags: np.ndarray, starts: np.ndarray, dests: int) -> Iterator[tuple[int, bytes]]:
    """Places of late windows, packed by the part of the documents they go to."""
    if not len(ids):
        return
    dest = _dest(ids, dests, tags)
    order = np.lexsort((starts, tags, ids, dest))
    dest, ids, tags, starts = dest[order], ids[order], tags[order].astype(np.int64), starts[order]
    for lo, hi in _runs(dest):
        i, t = ids[lo:hi], tags[lo:hi]
        head = np.flatnonzero((np.diff(i, prepend=i[0]) != 0) | (np.diff(t, prepend=~t[0]) != 0))
        many = np.diff(head, append=hi - lo)
        yield int(dest[lo]), _joined(pack_ids(i[head]), t[head].astype(np.int64).tobytes(), _plain(many), pack(starts[lo:hi]))


class _Marks:
    """Late windows of one part's documents, sorted for look-up."""

    def __init__(self, packed: list[bytes]):
        ids, tags, starts = [], [], []
        for data in packed:
            i, t, many, s = _split(data)
            many = _unplain(many)
            ids.append(np.repeat(unpack_ids(i), many))
            tags.append(np.repeat(np.frombuffer(t, np.int64), many))
            starts.append(unpack(s))
        if packed:
            order = np.lexsort((np.concatenate(starts), np.concatenate(tags), np.concatenate(ids)))
            self.ids, self.tags, self.starts = (np.concatenate(x)[order] for x in (ids, tags, starts))
        else:
            self.ids = self.tags = self.starts = np.empty(0, np.int64)

    def of(self, doc_id: int, tag: int) -> np.ndarray:
        lo, hi = np.searchsorted(self.ids, doc_id), np.searchsorted(self.ids, doc_id, "right")
        a, b = np.searchsorted(self.tags[lo:hi], tag), np.searchsorted(self.tags[lo:hi], tag, "right")
        return np.unique(self.starts[lo + a : lo + b])


def _split(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        out.append(data[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def _hash_windows(batches, window: int, buckets: int, dests: int, block: int):
    held = _Block(buckets, dests)

    def out():
        rows = list(held.rows())
        for lo in range(0, len(rows), 2000):
            part = rows[lo : lo + 2000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.binary())], ["bucket", "payload"]
            )

    for batch in batches:
        for piece in slices(batch, "text"):
            buffer, offsets = text_bytes(piece.column("text"))
            begin, end, first = word_spans(buffer, offsets)
            words = span_hashes(buffer, begin, end)
            count = np.diff(first)
            start = np.arange(len(words)) - np.repeat(first[:-1], count)
            valid = np.flatnonzero(start + window <= np.repeat(count, count))
            if not len(valid):
                continue
            doc = np.repeat(np.arange(len(count), dtype=np.int32), count)[valid]
            h = mixed(window_hashes(words, window, BASE)[valid])
            g = mixed(window_hashes(mixed(words), window, BASE_2)[valid])
            tags = piece.column("text_hash").to_numpy(zero_copy_only=False)
            held.add(piece.column("doc_id").to_numpy(zero_copy_only=False), tags, doc, start[valid].astype(np.int32), h, g)
            if held.size >= block:
                yield from out()
    yield from out()


def _later_places(pdf: pd.DataFrame, dests: int) -> pd.DataFrame:
    """Places of the windows of a bucket that begin somewhere earlier too."""
    if pdf["bucket"].iloc[0] < 0:  # already decided by the task that held both places
        return pd.DataFrame({"dest": -1 - pdf["bucket"], "marks": pdf["payload"]})
    hs, ids, tags, starts = [], [], [], []
    for data in pdf["payload"]:
        h, i, t, many, s = _split(data)
        many = _unplain(many)
        hs.append(_from_seven(h))
        ids.append(np.repeat(unpack_ids(i), many))
        tags.append(np.repeat(np.frombuffer(t, np.int64), many))
        starts.append(unpack(s).astype(np.uint32))
    h = np.concatenate(hs)
    del hs
    order = np.argsort(h)
    h = h[order]
    twin = np.zeros(len(h) + 1, bool)
    twin[1:-1] = h[1:] == h[:-1]
    sub = order[twin[1:] | twin[:-1]]
    h = h[twin[1:] | twin[:-1]]
    if not len(sub):
        return pd.DataFrame({"dest": np.empty(0, np.int64), "marks": np.empty(0, object)})
    doc, tag, start = np.concatenate(ids)[sub], np.concatenate(tags)[sub], np.concatenate(starts)[sub]
    order = np.lexsort((start, tag, doc, h))
    h, doc, tag, start = h[order], doc[order], tag[order], start[order]
    head = np.flatnonzero(np.diff(h, prepend=h[0] ^ np.uint64(1)))
    group = np.repeat(head, np.diff(head, append=len(h)))
    late = (doc != doc[group]) | (tag != tag[group]) | (start != start[group])
    rows = list(_packed_marks(doc[late], tag[late], start[late], dests))
    return pd.DataFrame({"dest": np.array([r[0] for r in rows], np.int64), "marks": [r[1] for r in rows]})


def intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal intervals of words covered by windows at the sorted ``starts``."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > window) + 1
    return list(zip(starts[np.concatenate([[0], cut])].tolist(), (starts[np.concatenate([cut - 1, [len(starts) - 1]])] + window).tolist()))


def _apply(batches, window: int):
    """Texts without their marked words (rows come sorted by part, marks first)."""
    dest, packed, marks = None, [], None
    for batch in batches:
        rows = {"doc_id": [], "text": [], "n_words": [], "n_removed": [], "removed": [], "kept_sha256": []}
        for part, doc, tag, text, mark in zip(*(batch.column(c).to_pylist() for c in ("dest", "doc_id", "text_hash")), batch.column("text"), batch.column("marks")):
            if part != dest:
                dest, packed, marks = part, [], None
            if mark.is_valid:
                packed.append(mark.as_py())
                continue
            if marks is None:
                marks, packed = _Marks(packed), []
            raw = (text.as_py() or "").encode()
            words = raw.split()
            cuts = intervals(marks.of(doc, tag), window)
            kept, at = [], 0
            for lo, hi in cuts:
                kept += words[at:lo]
                at = hi
            kept += words[at:]
            joined = b" ".join(kept)
            rows["doc_id"].append(doc)
            rows["text"].append(joined.decode())
            rows["n_words"].append(len(words))
            rows["n_removed"].append(len(words) - len(kept))
            rows["removed"].append([{"begin": lo, "end": hi} for lo, hi in cuts])
            rows["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
        yield pa.RecordBatch.from_pydict(rows, schema=_OUT)


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text", pa.string()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("removed", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
        ("kept_sha256", pa.string()),
    ]
)
_OUT_DDL = "doc_id long, text string, n_words long, n_removed long, removed array<struct<begin: long, end: long>>, kept_sha256 string"


def remove_repeats(docs: DataFrame, window: int = WINDOW, bucket_mb: float = BUCKET_MB, block: int = BLOCK) -> DataFrame:
    """Each document without the words of windows that occurred before.

    Returns ``doc_id, text`` (kept words joined by one space), ``n_words``, ``n_removed``,
    ``removed`` (maximal intervals of word numbers, end exclusive) and ``kept_sha256``, one row
    per input row. Windows are judged on the input: (smaller doc_id, earlier start) is earlier.

    Null or empty text: no words, nothing removed. Null doc_id: after all others. Rows with one
    doc_id and different texts are told apart, and ordered, by a 64-bit hash of the text; rows equal
    in both count as one document and get the same result. Other columns are ignored.
    """
    docs = key_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    buckets, dests = parts_for(docs, bucket_mb), shuffle_parts(docs)
    sent = docs.mapInArrow(partial(_hash_windows, window=window, buckets=buckets, dests=dests, block=block), SENT)

    def later_places(pdf: pd.DataFrame) -> pd.DataFrame:
        return _later_places(pdf, dests)

    marks = sent.groupBy("bucket").applyInPandas(later_places, MARKS)
    dest = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(dests)).cast("long").alias("dest")
    rows = docs.select(dest, "doc_id", "text_hash", "text", F.lit(None).cast("binary").alias("marks"))
    none = [F.lit(None).cast(kind).alias(c) for c, kind in (("doc_id", "long"), ("text_hash", "long"), ("text", "string"))]
    both = rows.unionByName(marks.select("dest", *none, "marks"))
    both = both.repartition(dests, "dest").sortWithinPartitions("dest", F.col("marks").isNull(), "doc_id")
    return both.mapInArrow(partial(_apply, window=window), _OUT_DDL).withColumn("doc_id", original_id())
