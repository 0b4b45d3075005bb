"""Phrases whose words keep company: exact counts of word sequences, scored by their weakest cut.

Method: direct-address tiling. The words of a language are ranked by frequency and the rank is the word's id. The
ids are cut into ranges of about equal frequency, so pairs of neighbours fall into tiles of a grid with about equal
mass. A tile with few cells is counted in a dense array with bincount, a larger one as sorted coordinates. Frequent
pairs are ranked by frequency in turn and become the ids of the next round: two overlapping pairs side by side are a
phrase of three words, and so on.

At scale: texts are read once. A block (some megabytes of text of one language) is an array of numbers into its own
list of words; the list goes out in hash buckets, where words are counted and ranked, and comes back as ids. Ranks
are dealt to buckets in turn (a word of rank r in bucket b of B gets the id r * B + b + 1), which is the order of
frequency but for neighbours, without a sort in one place; no vocabulary is held in memory beyond a bucket's. From
then on a block is one array of ids. It adds up its own pairs before they are shuffled, one row per block and tile, so
a pair that makes up a third of the corpus is one number per block. Buckets and ranges grow with the corpus; a task
holds the distinct words of a bucket or the distinct pairs of a tile.

Null text counts as empty, a null language is ``und``. Repeated rows count as often as they stand there. Ties are
cut by the order of the words' bytes. An empty table, or one without frequent pairs, gives no rows. Other columns
are ignored. A language may have 2^31 ids a round; more is an error, never a wrong count.
"""

from __future__ import annotations

from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from slotwise.llm.frames import MB, parts_for
from slotwise.llm.text import LOWER, U64, slices, span_hashes, text_bytes, word_spans
from slotwise.session import materialise

BLOCK_MB = 4
BUCKET_MB = 4  # text of the corpus for each bucket of its words
CELLS = 1 << 20  # a tile of up to so many cells is counted in a dense array
HELD = 1 << 21  # coordinates a sparse tile gathers before it adds them up
TILE_PAIRS = 2_000_000  # neighbours a tile should have
LEAST_RANGES = 16
SENT_BOUNDS = 1 << 21  # ids of range bounds (16 MB) up to which every executor gets all; above it they are joined
COVERED = 50  # percent

_SPACE = (0x20, 0x09)
_STOPS = (*b".,;:!?", *range(0x0A, 0x0E))
_IS_WORD = np.ones(256, bool)
_IS_WORD[[*_SPACE, *_STOPS]] = False
_IS_STOP = np.zeros(256, bool)
_IS_STOP[list(_STOPS)] = True


def places(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes, begin and end of every word, and its place.

    Places of neighbours in one piece follow each other; a number is left out between pieces and texts.
    """
    buffer, offsets = text_bytes(texts)
    buffer = LOWER[buffer]
    begin, end, first = word_spans(buffer, offsets, _IS_WORD)
    if not len(begin):
        return buffer, begin, end, begin
    stops = np.append(np.flatnonzero(_IS_STOP[buffer]), len(buffer))
    apart = stops[np.searchsorted(stops, end[:-1])] < begin[1:]
    apart[(cut := first[1:-1])[(cut > 0) & (cut < len(begin))] - 1] = True
    place = np.arange(len(begin))
    place[1:] += np.cumsum(apart)
    return buffer, begin, end, place


def _expand(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges ``begin .. begin + size``."""
    return np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)


def shrink(values: np.ndarray, ordered: bool = False) -> bytes:
    """Integers of 4 or 8 bytes as compressed byte planes; ``ordered`` ones as steps."""
    width = values.dtype.itemsize
    steps = np.diff(values, prepend=values.dtype.type(0)) if ordered else values
    planes = np.ascontiguousarray(steps).view(np.uint8).reshape(-1, width).T.tobytes()
    return np.array([len(values), width, ordered], np.int32).tobytes() + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def grow(data: bytes) -> np.ndarray:
    size, width, ordered = (int(x) for x in np.frombuffer(data, np.int32, 3))
    kind = np.int32 if width == 4 else np.int64
    if not size:
        return np.empty(0, kind)
    planes = np.frombuffer(pa.decompress(data[12:], size * width, "zstd"), np.uint8)
    values = np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if ordered else values


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a new run of equal rows begins."""
    if not len(columns[0]):
        return np.empty(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _groups(batches, *keys: str):
    """Key values, and the parts of batches that have them, of batches sorted by ``keys``."""

    def parts():
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k) for k in keys]
            coded = [(c.dictionary_encode().indices if pa.types.is_string(c.type) else c).to_numpy(zero_copy_only=False) for c in columns]
            begins = _starts(*coded).tolist()
            for a, b in zip(begins, [*begins[1:], batch.num_rows]):
                yield tuple(c[a].as_py() for c in columns), batch.slice(a, b - a)

    for key, run in groupby(parts(), lambda p: p[0]):
        yield key, (part for _, part in run)


BLOCKS = "bucket int, block long, lang string, first int, data binary"


def _blocks(batches, buckets: int, block_mb: int):
    """A row per block (bucket -1): its places as numbers into its list of words, 0 where a piece ends; and a row
    per block and bucket: the words of the list that belong there, with their counts."""
    number = TaskContext.get().partitionId() << 34
    for batch in batches:
        for piece in slices(batch, "text", block_mb * MB):
            for lang in piece.column("lang").unique():
                buffer, begin, end, place = places(piece.filter(pa.compute.equal(piece.column("lang"), lang)).column("text"))
                if not len(begin):
                    continue
                h = span_hashes(buffer, begin, end)
                order = np.argsort(h, kind="stable")
                h = h[order]
                starts = _starts(h)
                local = np.zeros(len(order), np.int32)
                local[starts] = 1
                sequence = np.zeros(place[-1] + 1, np.int32)
                sequence[place[order]] = np.cumsum(local, dtype=np.int32)
                n, one = np.diff(np.append(starts, len(order))).astype(np.int32), order[starts]
                bucket = ((h[starts] >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
                del h, order, local, place
                begin, size = begin[one], (end[one] - begin[one]).astype(np.int32)
                rows = [(-1, 0, shrink(sequence))]
                cuts = _starts(bucket)
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
                    text = buffer[_expand(begin[a:b], size[a:b])].tobytes()
                    head = shrink(np.concatenate([n[a:b], size[a:b]]))
                    data = np.int32(len(head)).tobytes() + head + pa.compress(text, "zstd", asbytes=True)
                    rows.append((int(bucket[a]), a, data))
                for at in range(0, len(rows), 256):
                    some = rows[at : at + 256]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r[0] for r in some], pa.int32()),
                            pa.array([number] * len(some), pa.int64()),
                            pa.array([lang.as_py()] * len(some), pa.string()),
                            pa.array([r[1] for r in some], pa.int32()),
                            pa.array([r[2] for r in some], pa.binary()),
                        ],
                        ["bucket", "block", "lang", "first", "data"],
                    )
                number += 1


def _words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Counts, lengths and bytes of the words of a block's row."""
    head = int(np.frombuffer(data, np.int32, 1)[0])
    n, size = np.split(grow(data[4 : 4 + head]), 2)
    return n, size, pa.decompress(data[4 + head :], int(size.sum()), "zstd", asbytes=True)


VOCABULARY = "lang string, block long, first int, data binary, id long, word string, n long"


def _vocabulary(batches, buckets: int, least: int):
    """Of each bucket: its frequent words with id and count, a row with the sum of all counts (id 0), and for each
    block the ids of its words in the order it sent them, 0 for the rare ones."""
    for (lang, bucket), parts in _groups(batches, "lang", "bucket"):
        blocks, firsts, counts, sizes, texts = [], [], [], [], []
        for part in parts:
            for block, first, data in zip(part.column("block").to_pylist(), part.column("first").to_pylist(), part.column("data").to_pylist()):
                n, size, text = _words_of(data)
                for into, x in zip((blocks, firsts, counts, sizes, texts), (block, first, n, size, text)):
                    into.append(x)
        buffer = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
        del texts
        size = np.concatenate(sizes).astype(np.int64)
        begin = np.cumsum(size) - size
        h, n = span_hashes(buffer, begin, begin + size), np.concatenate(counts).astype(np.int64)
        order = np.argsort(h, kind="stable")
        starts = _starts(h[order])
        other = span_hashes(buffer, begin, begin + size, 1)[order]
        if len(_starts(h[order], other)) != len(starts):
            raise ValueError("hash of words collided")
        total, one = np.add.reduceat(n[order], starts), order[starts]
        often = np.flatnonzero(total >= least)
        often = often[np.lexsort((h[one[often]], -total[often]))]
        ids = np.zeros(len(starts), np.int64)
        ids[often] = np.arange(len(often)) * buckets + bucket + 1
        if len(ids) and ids.max() >= 1 << 31:
            raise ValueError("more than 2^31 ids")
        of_word = np.zeros(len(order), np.int32)
        of_word[order] = np.repeat(ids, np.diff(np.append(starts, len(order))))
        rows, a = [], 0
        for block, first, each in zip(blocks, firsts, sizes):
            some = of_word[a : a + len(each)]
            a += len(each)
            if some.any():
                rows.append((block, first, shrink(some)))
        empty = lambda k: [None] * k
        text = buffer.tobytes()
        words = [text[begin[i] : begin[i] + size[i]].decode() for i in one[often]]
        columns = [
            [lang] * (len(rows) + len(words) + 1),
            [r[0] for r in rows] + empty(len(words) + 1),
            [r[1] for r in rows] + empty(len(words) + 1),
            [r[2] for r in rows] + empty(len(words) + 1),
            empty(len(rows)) + ids[often].tolist() + [0],
            empty(len(rows)) + words + [None],
            empty(len(rows)) + total[often].tolist() + [int(n.sum())],
        ]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "block", "first", "data", "id", "word", "n"])


SEQUENCE = "block long, lang string, ids binary"


def _sequence_row(block: int, lang: str, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([lang], pa.string()), pa.array([shrink(ids)], pa.binary())], ["block", "lang", "ids"])


def _sequences(batches):
    """The array of ids of each block, 0 where the chain of frequent words breaks. Its places come first (first is
    null), then the ids of its words."""
    for (block, lang), parts in _groups(batches, "block", "lang"):
        sequence, of_word = None, None
        for part in parts:
            for first, data in zip(part.column("first").to_pylist(), part.column("data").to_pylist()):
                if first is None:
                    sequence = grow(data)
                    of_word = np.zeros(sequence.max() + 1, np.int32)
                else:
                    ids = grow(data)
                    of_word[first + 1 : first + 1 + len(ids)] = ids
        if of_word.any():
            yield _sequence_row(block, lang, of_word[sequence])


class _Cells:
    """The distinct pairs of neighbours in an array of ids, sorted by tile and by cell in the tile."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray):
        both = (ids[:-1] > 0) & (ids[1:] > 0)
        self.at = np.flatnonzero(both)
        key, self.of, n = np.unique((ids[self.at].astype(np.int64) << 32) | ids[self.at + 1], return_inverse=True, return_counts=True)
        a, b, self.width = key >> 32, key & 0xFFFFFFFF, np.diff(bounds)
        left, right = (np.searchsorted(bounds, x, "right") - 1 for x in (a, b))
        code = (a - bounds[left]) * self.width[right] + b - bounds[right]
        order = np.argsort(left * len(self.width) + right, kind="stable")  # codes of a tile stay sorted
        self.left, self.right, self.code, self.n, self.order = left[order], right[order], code[order], n[order].astype(np.int32), order
        self.starts = _starts(self.left, self.right)
        self.ends = np.append(self.starts[1:], len(order))


def _bounds(batch: pa.RecordBatch, row: int) -> np.ndarray:
    return batch.column("bounds")[row].values.to_numpy(zero_copy_only=False)


PAIR_ROWS = "block long, lang string, left int, right int, cells long, codes binary, n binary"


def _pairs(batches, counted: bool):
    """A row per block and tile: the distinct pairs of neighbours as cells of the tile, with their counts."""
    for batch in batches:
        for row in range(batch.num_rows):
            found = _Cells(grow(batch.column("ids")[row].as_py()), _bounds(batch, row))
            spans = list(zip(found.starts.tolist(), found.ends.tolist()))
            one, two = found.left[found.starts], found.right[found.starts]
            cells = found.width[one] * found.width[two]
            codes = [shrink(found.code[a:b].astype(np.int32 if c < 1 << 31 else np.int64), ordered=True) for (a, b), c in zip(spans, cells.tolist())]
            n = [shrink(found.n[a:b]) if counted else None for a, b in spans]
            whole = [[batch.column(c)[row].as_py()] * len(spans) for c in ("block", "lang")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(whole[0], pa.int64()), pa.array(whole[1], pa.string()), pa.array(one, pa.int32()), pa.array(two, pa.int32()), pa.array(cells, pa.int64()), pa.array(codes, pa.binary()), pa.array(n, pa.binary())],
                ["block", "lang", "left", "right", "cells", "codes", "n"],
            )


def _added(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted coordinates, each once, with the sums of their counts."""
    code, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    starts = _starts(code)
    return code[starts], np.add.reduceat(n, starts) if len(starts) else n


def _tiles(batches, least: int):
    """The frequent pairs of each tile: dense cells by bincount, many cells as sorted coordinates."""
    for (lang, left, right), parts in _groups(batches, "lang", "left", "right"):
        dense, codes, counts, held = None, [], [], 0
        for part in parts:
            cells = part.column("cells")[0].as_py()
            for code, n in zip(map(grow, part.column("codes").to_pylist()), map(grow, part.column("n").to_pylist())):
                codes, counts, held = [*codes, code], [*counts, n.astype(np.int64)], held + len(code)
                if held > HELD:
                    if cells <= CELLS:
                        dense = _counted(codes, counts, cells, dense)
                        codes, counts, held = [], [], 0
                    else:
                        one, two = _added(codes, counts)
                        codes, counts, held = [one], [two], min(len(one), held // 2)
        if cells <= CELLS:
            dense = _counted(codes, counts, cells, dense)
            code, n = np.arange(len(dense)), dense
        else:
            code, n = _added(codes, counts)
        code, n = code[n >= least].astype(np.int64), n[n >= least]
        fixed = [pa.array([x] * len(code), t) for x, t in ((lang, pa.string()), (left, pa.int32()), (right, pa.int32()))]
        yield pa.RecordBatch.from_arrays([*fixed, pa.array(code), pa.array(n)], ["lang", "left", "right", "code", "n"])


def _counted(codes: list[np.ndarray], counts: list[np.ndarray], cells: int, dense: np.ndarray | None) -> np.ndarray:
    """A dense tile with more pairs counted into it; sums below 2^53 are exact."""
    none = np.empty(0, np.int64)
    found = np.bincount(np.concatenate([none, *codes]), np.concatenate([none, *counts]), cells).astype(np.int64)
    return found if dense is None else dense + found


def _found(batches):
    """For each block and tile the ids of its pairs, 0 for rare ones, from a tile's frequent pairs (which come first)."""
    names = ["block", "lang", "left", "right", "ids"]
    for (lang, left, right), parts in _groups(batches, "lang", "left", "right"):
        known, table = [], None
        for part in parts:
            own = part.column("block").is_null().to_numpy(zero_copy_only=False)
            if own.any():
                some = part.filter(pa.array(own))
                known.append([some.column(c).to_numpy() for c in ("code", "id")])
            if own.all() or not known:
                continue
            if table is None:
                code, number = (np.concatenate(k) for k in zip(*known))
                order = np.argsort(code)
                table = code[order], number[order].astype(np.int32)
            some = part.filter(pa.array(~own))
            blocks, ids = [], []
            for block, code in zip(some.column("block").to_pylist(), map(grow, some.column("codes").to_pylist())):
                at = np.minimum(np.searchsorted(table[0], code), len(table[0]) - 1)
                number = np.where(table[0][at] == code, table[1][at], np.int32(0))
                if number.any():
                    blocks.append(block)
                    ids.append(shrink(number))
            fixed = [pa.array([x] * len(blocks), t) for x, t in ((lang, pa.string()), (left, pa.int32()), (right, pa.int32()))]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), *fixed, pa.array(ids, pa.binary())], names)


def _next(batches):
    """The array of pair ids of each block, from its array of ids (which comes first) and the ids of its pairs."""
    for (block, lang), parts in _groups(batches, "block", "lang"):
        cells, numbers, ids = None, None, None
        for part in parts:
            for row in range(part.num_rows):
                data, left = part.column("ids")[row].as_py(), part.column("left")[row].as_py()
                if left is None:
                    ids = grow(data)
                    cells = _Cells(ids, _bounds(part, row))
                    numbers = np.zeros(len(cells.order), np.int32)
                    tiles = {(a, b): i for i, (a, b) in enumerate(zip(cells.left[cells.starts].tolist(), cells.right[cells.starts].tolist()))}
                else:
                    i = tiles[left, part.column("right")[row].as_py()]
                    numbers[cells.starts[i] : cells.ends[i]] = grow(data)
        if not numbers.any():
            continue
        of_key = np.zeros(len(numbers), np.int32)
        of_key[cells.order] = numbers
        out = np.zeros(len(ids) - 1, np.int32)
        out[cells.at] = of_key[cells.of]
        yield _sequence_row(block, lang, out)


def running(rows: DataFrame, *order) -> DataFrame:
    """``rows`` (lang, n, more) with ``rank``, their number by ``order`` within the language from 1, ``before``, the
    sum of n of the rows before, and ``mass``, that of all rows of the language. Sums over range partitions take the
    place of a sort in one task."""
    dealt = materialise(rows.repartitionByRange("lang", *order).withColumn("part", F.spark_partition_id()), "running")
    sizes = dealt.groupBy("lang", "part").agg(F.count("*").alias("rows"), F.sum("n").alias("mass"))
    earlier = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("lang", "part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("rows", "mass")), F.sum("mass").over(Window.partitionBy("lang")).alias("mass"))
    own = Window.partitionBy("lang", "part").orderBy(*order)
    mass = F.coalesce(F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = dealt.withColumns({"rank": F.row_number().over(own).cast("long"), "before": mass}).join(sizes, ["lang", "part"])
    return placed.withColumns({"rank": F.col("rank") + F.col("rows_before"), "before": F.col("before") + F.col("mass_before")}).drop("part", "rows_before", "mass_before")


def ranges(units: DataFrame) -> DataFrame:
    """``lang, bounds``: the first id of each range of about equal frequency, and the id after the last.

    The number of ranges is the square root of the tiles a language should have.
    """
    count = F.greatest(F.lit(LEAST_RANGES), F.ceil(F.sqrt(F.col("mass") / TILE_PAIRS)))
    number = F.floor(F.col("before").cast("double") * count / F.col("mass"))
    firsts = units.groupBy("lang", number.alias("range")).agg(F.min("id").alias("lo"), F.max("id").alias("last"))
    bounds = firsts.groupBy("lang").agg(F.array_append(F.sort_array(F.collect_list("lo")), F.max("last") + 1).alias("bounds"))
    bounds = materialise(bounds, "bounds")
    size = bounds.agg(F.sum(F.size("bounds"))).first()[0] or 0
    return F.broadcast(bounds) if size <= SENT_BOUNDS else bounds


def _in_groups(rows: DataFrame, keys: list[str], *order) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order)


def frequent_pairs(sequences: DataFrame, bounds: DataFrame, least: int) -> DataFrame:
    """``lang, left, right, code, a, b, n`` of all pairs of neighbouring ids that occur at least ``least`` times."""
    made = sequences.join(bounds, "lang").mapInArrow(partial(_pairs, counted=True), PAIR_ROWS)
    tiles = "lang string, left int, right int, code long, n long"
    rows = _in_groups(made, ["lang", "left", "right"]).mapInArrow(partial(_tiles, least=least), tiles).join(bounds, "lang")
    first = lambda side: F.element_at("bounds", F.col(side) + 1)
    width = F.element_at("bounds", F.col("right") + 2) - first("right")
    rows = rows.select("lang", "left", "right", "code", "n", first("left").alias("_l"), first("right").alias("_r"), width.alias("_w"))
    a, b = F.expr("code div _w + _l"), F.expr("code % _w + _r")
    return rows.select("lang", "left", "right", "code", a.alias("a"), b.alias("b"), "n")


def _nulls(**kinds: str) -> list:
    return [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]


def next_sequences(sequences: DataFrame, bounds: DataFrame, pairs: DataFrame) -> DataFrame:
    """The arrays of ids with each pair of neighbours replaced by its id in ``pairs``, or 0."""
    whole = sequences.join(bounds, "lang")
    own = whole.mapInArrow(partial(_pairs, counted=False), PAIR_ROWS)
    own = own.select("lang", "left", "right", "block", "codes", *_nulls(code="long", id="long"))
    known = pairs.select("lang", "left", "right", *_nulls(block="long", codes="binary"), "code", "id")
    both = _in_groups(own.unionByName(known), ["lang", "left", "right"], F.col("block").asc_nulls_first())
    found = both.mapInArrow(_found, "block long, lang string, left int, right int, ids binary")
    whole = whole.select("block", "lang", *_nulls(left="int", right="int"), "ids", "bounds")
    both = whole.unionByName(found.select("*", *_nulls(bounds="array<long>")))
    return _in_groups(both, ["block", "lang"], F.col("left").asc_nulls_first()).mapInArrow(_next, SEQUENCE)


def _score(k: int, words: int) -> str:
    """SQL of the score of the cut after ``k`` words; decimals hold products past 64 bits."""
    square = "(cast(n as decimal(19,0)) * cast(n as decimal(19,0)))"
    parts = f"(cast(pre[{k - 1}] as decimal(19,0)) * cast(suf[{words - k - 1}] as decimal(19,0)))"
    return f"(cast(1000000 as decimal(7,0)) * {square}) div {parts}"


def phrases(docs: DataFrame, max_words: int = 3, least: int = 10, top: int = 2000, covered: int = COVERED, block_mb: int = BLOCK_MB) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the first ``top`` phrases of each language.

    Words are runs of bytes other than space and tab in pieces cut at ``.,;:!?`` and 0x0A-0x0D, with A-Z lowered.
    A phrase of 2 to ``max_words`` words that occurs at least ``least`` times within pieces is scored by its
    weakest cut, floor(10^6 * a * a / (l * r)); one that lies in a longer such phrase with at least ``covered``
    percent of its occurrences is left out.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    texts = docs.select(lang, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    buckets = parts_for(texts, BUCKET_MB)
    blocks = materialise(texts.mapInArrow(partial(_blocks, buckets=buckets, block_mb=block_mb), BLOCKS), "blocks")
    lists = _in_groups(blocks.where("bucket >= 0"), ["lang", "bucket"], "block")
    known = materialise(lists.mapInArrow(partial(_vocabulary, buckets=buckets, least=least), VOCABULARY), "vocabulary")
    totals = known.where("id = 0").groupBy("lang").agg(F.sum("n").alias("total"))
    none = F.array().cast("array<long>")
    units = running(known.where("id > 0").select("lang", "id", "n", "word"), "id").select("lang", "id", "before", "mass", "n", F.col("word").alias("phrase"), none.alias("pre"), none.alias("suf"))
    units = materialise(units, "units")
    rows = blocks.where("bucket < 0").select("block", "lang", *_nulls(first="int"), "data")
    rows = rows.unionByName(known.where("block IS NOT NULL").select("block", "lang", "first", "data"))
    sequences = materialise(_in_groups(rows, ["block", "lang"], F.col("first").asc_nulls_first()).mapInArrow(_sequences, SEQUENCE), "sequences")
    levels, above = [], None
    for words in range(2, max_words + 1):
        bounds = ranges(units)
        pairs = materialise(running(frequent_pairs(sequences, bounds, least), F.col("n").desc(), "a", "b").withColumnRenamed("rank", "id"), "pairs")
        one, two = (units.select("lang", F.col("id").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in ("n", "phrase", "pre", "suf"))) for c in "ab")
        wide = pairs.join(one, ["lang", "a"]).join(two, ["lang", "b"])
        units = materialise(
            wide.select(
                "lang", "id", "before", "mass", "n", "a", "b",
                F.concat("phrase_a", F.lit(" "), F.substring_index("phrase_b", " ", -1)).alias("phrase"),
                F.array_append("pre_a", F.col("n_a")).alias("pre"),
                F.array_append("suf_b", F.col("n_b")).alias("suf"),
            ),
            "units",
        )
        if above is not None:
            inside = units.select("lang", F.explode(F.array("a", "b")).alias("id"), "n").groupBy("lang", "id").agg(F.max("n").alias("longer"))
            levels[-1] = above.join(inside, ["lang", "id"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("n") * covered))
        best = F.array_min(F.array(*(F.struct(F.expr(_score(k, words)).alias("score"), F.lit(k).alias("k")) for k in range(1, words))))
        above = units.withColumns({"best": best}).select("lang", "id", "phrase", "n", "best.score", F.expr("pre[best.k - 1]").alias("l"), F.expr(f"suf[{words} - best.k - 1]").alias("r"))
        levels.append(above)
        if words < max_words:
            sequences = materialise(next_sequences(sequences, bounds, pairs), "sequences")
    kept = levels[0].select("lang", "phrase", "n", "score", "l", "r")
    for level in levels[1:]:
        kept = kept.unionByName(level.select(*kept.columns))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("n").desc(), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("n").alias("a"), "l", "r", F.col("total").alias("n"), "score")
