"""Token ids in binary files of patched frame-of-reference blocks.

A file holds segments. A segment holds the ids of some documents in blocks of ``BLOCK``: each block
subtracts its minimum and packs the rest at the width that holds ``percentile`` of its ids; ids that
need more bits stand in an exception list with their places. An index gives each block's start.

    "PFR1", then 8-byte numbers: sequence number, documents, ids, blocks
    8-byte lengths of the parts, then the parts: document ids and lengths (byte planes), index
    (per block: start and minimum 4 bytes each, exceptions 2, width 1), body
    body of a block: BLOCK * width / 8 bytes (eight ids in ``width`` bytes, lowest bits first),
    then 2-byte places and 4-byte values of its exceptions

At scale: texts move once, into buckets that follow doc_id; a bucket is a file of a few MB, and the
ids before a document come from running sums over buckets (one row each) and inside a bucket. A doc_id
with more text than a bucket (that of rows without one, say) has buckets of its own, cut by the hash of the text.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from slotwise.llm.bpe import END_ID, encoder, vocabulary_path
from slotwise.llm.files import read_binary, write_binary
from slotwise.llm.frames import BIGGEST, MB, key_and_text, original_id, parts_for
from slotwise.llm.order import bucket_bounds, bucket_of
from slotwise.llm.text import pack_ids, slices, text_bytes, unpack_ids
from slotwise.session import materialise, scratch_dir

BLOCK = 512
PERCENTILE = 0.95
SEGMENT = 500_000  # ids
BUCKET_MB = 16
PARTS = 1_000_000  # buckets one doc_id may fill
MAGIC = b"PFR1"


def pack_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, bytes]:
    """``(index, body)`` of the ids; the last block is filled up with its own minimum."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return b"", b""
    full = np.empty(blocks * BLOCK, np.uint32)
    full[:n] = ids
    full[n:] = ids[(blocks - 1) * BLOCK :].min()
    full = full.reshape(blocks, BLOCK)
    low = full.min(axis=1)
    rest = full - low[:, None]
    width = np.zeros(blocks, np.int64)
    fit = np.sort(rest, axis=1)[:, min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)]
    width[fit > 0] = np.floor(np.log2(fit[fit > 0])).astype(np.int64) + 1
    over = rest.astype(np.int64) >> width[:, None] != 0
    extra = over.sum(axis=1)
    size = BLOCK // 8 * width + 6 * extra
    begin = np.cumsum(size) - size
    body = np.zeros(int(size.sum()), np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        of = np.flatnonzero(width == w)
        v = (rest[of].astype(np.uint64) & np.uint64((1 << w) - 1)).reshape(-1, 8)
        words = np.zeros((len(v), -(-w // 8)), np.uint64)
        for j in range(8):
            word, shift = divmod(j * w, 64)
            words[:, word] |= v[:, j] << np.uint64(shift)
            if shift + w > 64:
                words[:, word + 1] |= v[:, j] >> np.uint64(64 - shift)
        packed = words.view(np.uint8)[:, :w].reshape(len(of), -1)
        body[begin[of][:, None] + np.arange(packed.shape[1])] = packed
    for k in np.flatnonzero(extra).tolist():
        place = np.flatnonzero(over[k])
        at = int(begin[k] + BLOCK // 8 * width[k])
        tail = place.astype("<u2").tobytes() + rest[k, place].astype("<u4").tobytes()
        body[at : at + len(tail)] = np.frombuffer(tail, np.uint8)
    index = np.zeros(blocks, _INDEX)
    index["start"], index["low"], index["extra"], index["width"] = begin, low, extra, width
    return index.tobytes(), body.tobytes()


_INDEX = np.dtype([("start", "<u4"), ("low", "<u4"), ("extra", "<u2"), ("width", "u1")])


def unpack_blocks(index: bytes, body: bytes, n: int) -> np.ndarray:
    index = np.frombuffer(index, _INDEX)
    data = np.frombuffer(body, np.uint8)
    begin, width = index["start"].astype(np.int64), index["width"].astype(np.int64)
    rest = np.zeros((len(index), BLOCK), np.uint64)
    for w in np.unique(width[width > 0]).tolist():
        of = np.flatnonzero(width == w)
        packed = data[begin[of][:, None] + np.arange(BLOCK // 8 * w)].reshape(-1, w)
        padded = np.zeros((len(packed), 8 * -(-w // 8)), np.uint8)
        padded[:, :w] = packed
        words, v = padded.view(np.uint64), np.empty((len(packed), 8), np.uint64)
        for j in range(8):
            word, shift = divmod(j * w, 64)
            v[:, j] = words[:, word] >> np.uint64(shift)
            if shift + w > 64:
                v[:, j] |= words[:, word + 1] << np.uint64(64 - shift)
        rest[of] = (v & np.uint64((1 << w) - 1)).reshape(len(of), BLOCK)
    for k in np.flatnonzero(index["extra"]).tolist():
        at, m = int(begin[k] + BLOCK // 8 * width[k]), int(index["extra"][k])
        place = np.frombuffer(body, "<u2", m, at)
        rest[k, place] = np.frombuffer(body, "<u4", m, at + 2 * m)
    return (rest + index["low"][:, None]).astype(np.uint32).ravel()[:n]


def segment(sequence: int, doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    index, body = pack_blocks(ids, percentile)
    parts = (pack_ids(doc_ids), pack_ids(lengths), index, body)
    head = np.array([sequence, len(doc_ids), len(ids), len(index) // _INDEX.itemsize, *map(len, parts)], "<u8").tobytes()
    return MAGIC + head + b"".join(parts)


def segments(content: bytes):
    """``(sequence, doc_ids, lengths, ids)`` of every segment of a file, in their order."""
    at, found = 0, []
    while at < len(content):
        if content[at : at + 4] != MAGIC:
            raise ValueError("not a token file")
        sequence, _, n, _, *sizes = np.frombuffer(content, "<u8", 8, at + 4).astype(np.int64).tolist()
        begin = at + 68
        found.append((sequence, begin, n, sizes))
        at = begin + sum(sizes) + 1  # a line end follows
    for sequence, begin, n, sizes in sorted(found):
        a, b, c, d = np.cumsum([begin, *sizes[:3]]).tolist()
        ids = unpack_blocks(content[c:d], content[d : d + sizes[3]], n)
        yield sequence, unpack_ids(content[a:b]), unpack_ids(content[b:c]), ids


def _encode(batches, path: str, segment_ids: int, percentile: float, end_id: int):
    """Segments of the buckets of a partition sorted by (bucket, doc_id)."""
    tool, now, sequence, held, size = encoder(path), None, 0, [], 0

    def flush():
        nonlocal sequence, held, size
        docs, lengths, ids = (np.concatenate([h[i] for h in held]) for i in range(3))
        out = pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int64()), pa.array([segment(sequence, docs, lengths, ids, percentile)], pa.binary())], ["bucket", "payload"]
        )
        sequence, held, size = sequence + 1, [], 0
        return out

    for batch in batches:
        buckets = batch.column("bucket").to_numpy()
        for lo, hi in zip(*_bounds(buckets)):
            if buckets[lo] != now:
                if held:
                    yield flush()
                now, sequence = int(buckets[lo]), 0
            for piece in slices(batch.slice(lo, hi - lo), "text", 2 << 20):
                buffer, offsets = text_bytes(piece.column("text"))
                ids, count = tool.encode(buffer, offsets)
                stop = np.cumsum(count + 1) - 1
                full = np.empty(len(ids) + len(count), np.uint32)
                is_end = np.zeros(len(full), bool)
                is_end[stop] = True
                full[is_end], full[~is_end] = end_id, ids
                held.append((piece.column("doc_id").to_numpy(), count + 1, full))
                size += len(full)
                if size >= segment_ids:
                    yield flush()
    if held:
        yield flush()


def _bounds(values: np.ndarray):
    cut = np.flatnonzero(np.diff(values)) + 1
    return ([0, *cut.tolist()], [*cut.tolist(), len(values)]) if len(values) else ([], [])


def _hot_ids(docs: DataFrame, bucket_mb: float) -> dict[int, int]:
    """The doc_ids with more than twice a bucket's text, fewer than half as many as there are buckets, and how many
    buckets each fills."""
    limit = bucket_mb * MB
    sizes = docs.groupBy("doc_id").agg(F.sum(F.octet_length("text").cast("long")).alias("size"))
    return {r["doc_id"]: min(PARTS, -(-r["size"] // int(limit))) for r in sizes.where(F.col("size") > 2 * limit).collect()}


def _part(hot: dict[int, int]):
    """Number of the part of its doc_id that a row belongs to; parts ascend with the hash of the text."""
    if not hot:
        return F.lit(0).cast("long")
    parts = F.element_at(F.create_map(*(F.lit(x) for pair in hot.items() for x in pair)), F.col("doc_id"))
    share = F.xxhash64("text") / float(1 << 64) + 0.5
    return F.least(F.floor(share * F.coalesce(parts, F.lit(1))), F.coalesce(parts, F.lit(1)) - 1).cast("long")


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str | None = None, bucket_mb: float = BUCKET_MB, segment_ids: int = SEGMENT,
    percentile: float = PERCENTILE, end_id: int = END_ID,
) -> None:
    """Token ids of ``docs``, ``end_id`` after each, in files ``path/bucket=N/...``.

    Buckets, and documents in them, ascend by doc_id, then by a hash of the text. The tokenizer's
    file must lie at the same path on every executor. Null text counts as empty (only the end id);
    null doc_ids come last. Repeated rows are documents of their own. Other columns are ignored.
    """
    docs = key_and_text(docs)
    buckets = parts_for(docs, bucket_mb)
    bounds = bucket_bounds(docs.select("doc_id"), buckets)
    hot = _hot_ids(docs, bucket_mb)
    bounds = sorted({*bounds, *hot, *(h + 1 for h in hot if h < BIGGEST)})
    bucket = bucket_of("doc_id", bounds).cast("long") * PARTS + _part(hot)
    dealt = docs.withColumn("bucket", bucket).repartition(buckets + sum(hot.values()), "bucket")
    dealt = dealt.sortWithinPartitions("bucket", "doc_id", F.xxhash64("text"))
    work = partial(_encode, path=tokenizer or vocabulary_path(), segment_ids=segment_ids, percentile=percentile, end_id=end_id)
    write_binary(dealt.mapInArrow(work, "bucket long, payload binary"), path)


_READ = "bucket long, place long, doc_id long, before long, n_tokens long, ids_crc32 long"


def _digests(batches):
    for batch in batches:
        for bucket, content in zip(batch.column("bucket").to_pylist(), batch.column("content")):
            place = before = 0
            for _, docs, lengths, ids in segments(content.as_py()):
                stop = np.cumsum(lengths)
                data = ids.astype("<u4", copy=False).tobytes()
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip((stop - lengths).tolist(), stop.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": np.full(len(docs), bucket, np.int64), "place": place + np.arange(len(docs)), "doc_id": docs,
                        "before": before + stop - lengths, "n_tokens": lengths, "ids_crc32": np.array(crc, np.int64),
                    }
                )
                place, before = place + len(docs), before + int(stop[-1] if len(stop) else 0)


def _ids(batches):
    for batch in batches:
        for content in batch.column("content"):
            for _, docs, lengths, ids in segments(content.as_py()):
                stop = np.cumsum(lengths)
                rows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stop]), pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(docs), rows], ["doc_id", "ids"])


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, ids`` of every document in the files below ``path``."""
    return read_binary(spark, path).select("content").mapInArrow(_ids, "doc_id long, ids array<int>").withColumn("doc_id", original_id())


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files: ``start`` counts the ids of all documents before."""
    found = read_binary(spark, path).select(F.col("bucket").cast("long").alias("bucket"), "content").mapInArrow(_digests, _READ)
    found = materialise(found, "token-digests")
    totals = found.groupBy("bucket").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return found.join(totals, "bucket").select(original_id(), (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_digests(docs: DataFrame, path: str | None = None, **settings) -> DataFrame:
    """Write ``docs`` as token files (to a new folder of the shared scratch space unless given) and read them back.

    Empty table: no files, empty result.
    """
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "token-files")
    if docs.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    write_token_files(docs, path, **settings)
    return read_token_digests(spark, path)
