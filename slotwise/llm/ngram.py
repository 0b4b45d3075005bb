"""Interpolated modified Kneser-Ney bigram model.

Counting: a task hashes the tokens of its documents (64 bits), counts its own bigrams and sends
them, grouped by first word, to the shard of that word's hash. A shard adds up the counts, writes
its bigrams as a file of sorted hashes and counts, and passes on what words need: for each first
word its total and how many of its bigrams occur once, twice or more; for each second word how many
bigrams end in it. Word shards add these up and write files sorted by hash.

Scoring: workers map the files into memory and look up the distinct words and bigrams of some MB
of text at a time. The files lie in the shared scratch folder; where that is not a plain file
system, Spark fetches them to each executor.

At scale: a shard is about ``SHARD_MB`` of text. First words that would fill much of a shard (known
from a bounded sample of documents, which decides placement only) are dealt over several by
the second word. Nothing but a few counts of counts reaches the driver.

Files: "KN2B" or "KN2W", number of rows (8 bytes), bytes per item of each column (8 x 1 byte),
then the columns one after the other. Bigram files: hash, count. Word files: hash, count as token,
bigrams that begin with it and occur once / twice / more, bigrams that end in it.
"""

from __future__ import annotations

import glob
import mmap
import os
from collections import OrderedDict
from functools import partial
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyspark
from pyspark.sql import DataFrame, SparkSession, functions as F

from slotwise.llm.files import read_binary, write_binary
from slotwise.llm.frames import key_and_text, original_id, parts_for
from slotwise.llm.text import LOWER, U64, pair_hash, slices, span_hashes, text_bytes, word_spans
from slotwise.session import materialise, scratch_dir

SHARD_MB = 8
BLOCK = 1_500_000  # tokens a task counts before it sends them
SAMPLE_DOCS = 2_000  # for the placement of frequent first words only
OPEN_FILES = 1_000
BEGIN, END = U64(0x5BD1E9955BD1E995), U64(0xC6A4A7935BD1E995)


# --- tokens -------------------------------------------------------------------------------------


def bigrams(buffer: np.ndarray, offsets: np.ndarray):
    """Hashes of first and second token of every bigram, and the bigrams before each text (n + 1).

    Each text has a begin mark before it (never a second token) and an end token after it.
    """
    n = int(offsets[-1])
    lowered = buffer.copy()
    lowered[:n] = LOWER[buffer[:n]]
    begin, end, first = word_spans(lowered, offsets)
    words = span_hashes(lowered, begin, end)
    texts = len(offsets) - 1
    place = np.arange(len(words)) + np.repeat(np.arange(texts), np.diff(first))
    v, w = np.full(len(words) + texts, BEGIN), np.full(len(words) + texts, END)
    v[place + 1] = words
    w[place] = words
    at = first + np.arange(texts + 1)
    v[at[:-1]] = BEGIN
    return v, w, at


def shard_of(v: np.ndarray, w: np.ndarray, shards: int, heavy: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Shards follow the first word's hash; a heavy first word takes several, by the second word."""
    shard = _range_of(v, shards)
    if len(heavy[0]):
        at = np.searchsorted(heavy[0], v)
        at[at == len(heavy[0])] = 0
        split = heavy[0][at] == v
        shard[split] = (shard[split] + (w[split] >> U64(8)).astype(np.int64) % heavy[1][at[split]]) % shards
    return shard


def _range_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (((h >> U64(32)) * U64(shards)) >> U64(32)).astype(np.int64)


def _frequent(batches):
    """Share of each frequent first word in a sample, as counts of its documents' tokens."""
    for batch in batches:
        for piece in slices(batch, "text"):
            v, _, _ = bigrams(*text_bytes(piece.column("text")))
            word, count = np.unique(v, return_counts=True)
            keep = count * 100_000 >= len(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(word[keep].view(np.int64), 0)), pa.array(np.append(count[keep], 0)), pa.array(np.append(np.zeros(keep.sum(), np.int64), len(v)))],
                ["word", "n", "tokens"],
            )


def heavy_words(docs: DataFrame, shards: int, rows: int, sample: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of first words with more than half a shard's bigrams, and the shards each is dealt over."""
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, rows // max(1, sample)))) == 0)
    counted = some.select("text").mapInArrow(_frequent, "word long, n long, tokens long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("tokens").alias("t"))
    counted = materialise(counted, "frequent-words")
    total = max(1, counted.agg(F.sum("t")).first()[0] or 0)
    found = counted.where(F.col("n") * (2 * shards) > total).toPandas()  # at most 2 * shards rows
    word = found["word"].to_numpy(np.int64).view(np.uint64)
    many = np.ceil(2 * found["n"].to_numpy(np.float64) / total * shards).astype(np.int64)
    order = np.argsort(word)
    return word[order], np.minimum(many[order], shards)


# --- packed rows between tasks --------------------------------------------------------------------


def _joined(*columns: np.ndarray) -> bytes:
    out = []
    for c in columns:
        raw = c.tobytes() if c.dtype == np.uint64 else b"p" + c.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
        raw = b"u" + raw if c.dtype == np.uint64 else raw
        out.append(len(raw).to_bytes(8, "little") + raw)
    return b"".join(out)


def _parted(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        raw = data[at + 9 : at + 8 + n]
        if data[at + 8 : at + 9] == b"u":
            out.append(np.frombuffer(raw, np.uint64))
        else:
            out.append(np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel())
        at += 8 + n
    return out


def _file(magic: bytes, *columns: np.ndarray) -> bytes:
    """A model file; each column takes the fewest of 1, 2, 4 or 8 bytes an item."""
    fit = []
    for c in columns:
        most = int(c.max()) if len(c) else 0
        fit.append(c.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max)))
    sizes = bytes([c.itemsize for c in fit]).ljust(8, b"\0")
    # wide columns first in memory order would also align them; the 24-byte head keeps hashes aligned
    return magic + b"\0\0\0\0" + len(columns[0]).to_bytes(8, "little") + sizes + b"".join(c.tobytes() for c in fit)


def _columns(data) -> list[np.ndarray]:
    n, at, out = int.from_bytes(data[8:16], "little"), 24, []
    for size in bytes(data[16:24]).rstrip(b"\0"):
        out.append(np.frombuffer(data, f"<u{size}", n, at))
        at += n * size
    return out


# --- counting -----------------------------------------------------------------------------------


def _count(batches, shards: int, heavy, block: int):
    held, size = [], 0

    def out():
        nonlocal held, size
        v, w = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        held, size = [], 0
        _, first, count = np.unique(pair_hash(v, w), return_index=True, return_counts=True)
        v, w, count = v[first], w[first], count.astype(np.uint32)
        shard = shard_of(v, w, shards, heavy)
        order = np.lexsort((v, shard))
        v, w, count, shard = v[order], w[order], count[order], shard[order]
        cut = np.flatnonzero(np.diff(shard)) + 1
        rows = []
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(v)]):
            head = np.flatnonzero(np.diff(v[lo:hi], prepend=~v[lo]))
            many = np.diff(head, append=hi - lo)
            rows.append((int(shard[lo]), _joined(v[lo:hi][head], many, w[lo:hi], count[lo:hi])))
        for at in range(0, len(rows), 500):
            part = rows[at : at + 500]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.binary())], ["shard", "payload"])

    for batch in batches:
        for piece in slices(batch, "text"):
            v, w, _ = bigrams(*text_bytes(piece.column("text")))
            held.append((v, w))
            size += len(v)
            if size >= block:
                yield from out()
    if size:
        yield from out()


def _bigram_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """The shard's bigram file and what its words need."""
    parts = [_parted(data) for data in pdf["payload"]]
    v = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
    w, count = np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts]).astype(np.uint64)
    del parts
    key = pair_hash(v, w)
    order = np.argsort(key)
    key = key[order]
    head = np.flatnonzero(np.diff(key, prepend=~key[0]))
    key, v, w, count = key[head], v[order[head]], w[order[head]], np.add.reduceat(count[order], head)
    by_v = np.argsort(v)
    at = np.flatnonzero(np.diff(v[by_v], prepend=~v[by_v[0]]))
    sums = [np.add.reduceat(x[by_v], at) for x in (count, (count == 1).astype(np.uint64), (count == 2).astype(np.uint64), (count >= 3).astype(np.uint64))]
    word, ends = np.unique(w, return_counts=True)
    firsts = _joined(v[by_v[at]], *(_wide(s) for s in sums))
    rows = [("bigrams", _file(b"KN2B", key, count)), ("parts", len(firsts).to_bytes(8, "little") + firsts + _joined(word, _wide(ends)))]
    rows.append(("counts", np.array([np.count_nonzero(count == k) for k in (1, 2, 3, 4)], "<u8").tobytes()))
    return pd.DataFrame({"kind": [r[0] for r in rows], "shard": pdf["shard"].iloc[0], "payload": [r[1] for r in rows]})


def _wide(values: np.ndarray) -> np.ndarray:
    """Sums that fit 32 bits go as byte planes, others whole."""
    return values.astype(np.uint64) if len(values) and int(values.max()) >= 1 << 32 else values.astype(np.uint32)


def _deal_words(batches, shards: int):
    """The word rows of each bigram shard, dealt to word shards."""
    for batch in batches:
        for content in batch.column("content"):
            data = content.as_py()[:-1]  # without the line end
            n = int.from_bytes(data[:8], "little")
            for kind, part in ((0, data[8 : 8 + n]), (1, data[8 + n :])):
                columns = _parted(part)
                if not columns or not len(columns[0]):
                    continue
                cut = np.searchsorted(_range_of(columns[0], shards), np.arange(shards + 1))
                own = [s for s in range(shards) if cut[s] < cut[s + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array([kind] * len(own), pa.int32()), pa.array([_joined(*(c[cut[s] : cut[s + 1]] for c in columns)) for s in own], pa.binary())],
                    ["shard", "kind", "payload"],
                )


def _word_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """The word file of a shard and its share of the model's totals."""
    firsts = [_parted(d) for d, k in zip(pdf["payload"], pdf["kind"]) if k == 0]
    ends = [_parted(d) for d, k in zip(pdf["payload"], pdf["kind"]) if k == 1]
    word = np.unique(np.concatenate([p[0] for p in firsts + ends]))
    table = np.zeros((5, len(word)), np.uint64)
    for parts, rows in ((firsts, (0, 1, 2, 3)), (ends, (4,))):
        for p in parts:
            at = np.searchsorted(word, p[0])  # words are distinct inside a part
            for row, values in zip(rows, p[1:]):
                table[row, at] += values.astype(np.uint64)
    real = word != BEGIN
    end, token = table[4], table[0]
    known = int(np.count_nonzero(token[real] > 0))
    totals = [int(token[real].sum()), known, int(end.sum()), *(int(np.count_nonzero(end == k)) for k in (1, 2, 3, 4)), int(np.count_nonzero(end >= 3))]
    rows = [("words", _file(b"KN2W", word, *table)), ("totals", np.array(totals, "<u8").tobytes())]
    return pd.DataFrame({"kind": [r[0] for r in rows], "shard": pdf["shard"].iloc[0], "payload": [r[1] for r in rows]})


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of items that occur 1, 2, 3 and 4 times.

    Where one of the first three is zero, or a discount leaves its range, fixed ones are used.
    """
    n1, n2, n3, n4 = counts
    if min(n1, n2, n3) > 0:
        y = n1 / (n1 + 2 * n2)
        d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < x <= k for k, x in enumerate(d, 1)):
            return d
    return 0.5, 1.0, 1.5


def train(docs: DataFrame, path: str | None = None, shard_mb: float = SHARD_MB, block: int = BLOCK) -> dict:
    """Count ``docs`` and write the model's files; returns what :func:`score` needs besides them.

    Null text counts as empty: one bigram, begin mark and end.
    """
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "ngram-model")
    docs = key_and_text(docs)
    rows = docs.count()
    model = {"path": path, "shards": 1, "heavy": (np.empty(0, np.uint64), np.empty(0, np.int64)), "docs": rows}
    if not rows:
        return model | {"tokens": 0, "words": 0, "bigrams": 0, "d2": (0.5, 1.0, 1.5), "d1": (0.5, 1.0, 1.5), "spread": 0.0}
    shards = parts_for(docs, shard_mb)
    heavy = heavy_words(docs, shards, rows)
    sent = docs.select("text").mapInArrow(partial(_count, shards=shards, heavy=heavy, block=block), "shard long, payload binary")
    made = sent.groupBy("shard").applyInPandas(_bigram_shard, "kind string, shard long, payload binary")
    write_binary(made, path)
    dealt = read_binary(spark, f"{path}/kind=parts").select("content").mapInArrow(partial(_deal_words, shards=shards), "shard long, kind int, payload binary")
    write_binary(dealt.groupBy("shard").applyInPandas(_word_shard, "kind string, shard long, payload binary"), f"{path}/model")
    counts = _sum(spark, f"{path}/kind=counts", 4)
    totals = _sum(spark, f"{path}/model/kind=totals", 8)
    d1 = discounts(totals[3:7])
    kinds = (totals[3], totals[4], totals[7])
    return model | {
        "shards": shards, "heavy": heavy, "tokens": totals[0] + rows, "words": totals[1] + 1, "bigrams": totals[2], "d2": discounts(counts), "d1": d1,
        "spread": sum(d * k for d, k in zip(d1, kinds)) / totals[2],
    }


def _sum(spark: SparkSession, path: str, n: int) -> list[int]:
    """Column sums of the shards' small rows of numbers, added up in Spark."""

    def numbers(batches):
        for batch in batches:
            for content in batch.column("content"):
                values = np.frombuffer(content.as_py(), "<u8", n).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in values], [f"c{i}" for i in range(n)])

    rows = read_binary(spark, path).select("content").mapInArrow(numbers, ", ".join(f"c{i} long" for i in range(n)))
    return [int(x or 0) for x in rows.agg(*(F.sum(f"c{i}") for i in range(n))).first()]


# --- scoring ------------------------------------------------------------------------------------


def _local(path: str) -> str:
    """The folder on this machine: the shared one itself, or what Spark fetched of it."""
    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return parsed.path
    from pyspark import SparkFiles

    return SparkFiles.get(os.path.basename(path.rstrip("/")))


class _Model:
    """Mapped model files of a worker, the least recently used closed first."""

    def __init__(self, root: str):
        self.root, self.files = root, OrderedDict()

    def columns(self, kind: str, shard: int) -> list[np.ndarray] | None:
        key = (kind, shard)
        if key not in self.files:
            folder = f"model/kind={kind}" if kind == "words" else f"kind={kind}"
            names = glob.glob(f"{self.root}/{folder}/shard={shard}/part-*")
            if names:
                with open(names[0], "rb") as f:
                    self.files[key] = _columns(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
            else:
                self.files[key] = None  # nothing fell into this shard
            if len(self.files) > OPEN_FILES:
                self.files.popitem(last=False)
        self.files.move_to_end(key)
        return self.files[key]

    def look_up(self, kind: str, keys: np.ndarray, shard: np.ndarray, width: int) -> np.ndarray:
        """Columns after the hash for each key (zeros where absent); ``keys`` sorted within equal, adjoining shards."""
        out = np.zeros((width, len(keys)), np.float64)
        cut = np.flatnonzero(np.diff(shard)) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(keys)]):
            columns = self.columns(kind, int(shard[lo])) if hi > lo else None
            if not columns or not len(columns[0]):
                continue
            at = np.searchsorted(columns[0], keys[lo:hi])
            at[at == len(columns[0])] = 0
            hit = columns[0][at] == keys[lo:hi]
            for k in range(width):
                out[k, lo:hi][hit] = columns[k + 1][at[hit]]
        return out


def _model(path: str) -> _Model:
    held = pyspark.__dict__.setdefault("_ngram_models", {})
    if path not in held:
        held.clear()  # one model at a time stays mapped
        held[path] = _Model(_local(path))
    return held[path]


def _discount(count: np.ndarray, d: tuple) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(count, 3).astype(np.int64)]


def log_probabilities(v: np.ndarray, w: np.ndarray, model: dict, files: _Model):
    """log10 of each bigram's model probability and of its second token's add-one share, and whether that token is known."""
    word, inverse = np.unique(np.concatenate([v, w]), return_inverse=True)
    token, once, twice, more, ends = files.look_up("words", word, _range_of(word, model["shards"]), 5)
    context = token.copy()
    token[word == END] = model["docs"]
    token[word == BEGIN] = 0
    iv, iw = inverse[: len(v)], inverse[len(v) :]
    low = model["spread"] / (model["words"] + 1) if model["bigrams"] else 1 / (model["words"] + 1)
    lower = np.maximum(ends - _discount(ends, model["d1"]), 0) / max(1, model["bigrams"]) + low
    key, first, back = np.unique(pair_hash(v, w), return_index=True, return_inverse=True)
    shard = shard_of(v[first], w[first], model["shards"], model["heavy"])
    order = np.argsort(shard, kind="stable")
    count = np.empty(len(key))
    count[order] = files.look_up("bigrams", key[order], shard[order], 1)[0]
    kv, kw = iv[first], iw[first]
    d = model["d2"]
    seen = context[kv] > 0
    total = np.maximum(context[kv], 1)
    rest = np.where(seen, (d[0] * once[kv] + d[1] * twice[kv] + d[2] * more[kv]) / total, 1.0)
    p = np.maximum(count - _discount(count, d), 0) / total + rest * lower[kw]
    base = np.log10((token + 1) / (model["tokens"] + model["words"] + 1))
    return np.log10(p)[back], base[iw], token[iw] > 0


def _score(batches, model: dict):
    files = _model(model["path"])
    for batch in batches:
        for piece in slices(batch, "text"):
            v, w, at = bigrams(*text_bytes(piece.column("text")))
            p, base, known = log_probabilities(v, w, model, files)
            sums = [np.add.reduceat(x, at[:-1]) for x in (p, base, known.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), pa.array(np.diff(at)), pa.array(sums[2]), pa.array(sums[1]), pa.array(sums[0])],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` of ``docs`` (doc_id, text, held_out)."""
    spark = docs.sparkSession
    if urlparse(model["path"]).scheme not in ("", "file") and model["tokens"]:
        spark.sparkContext.addFile(model["path"], recursive=True)
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    rows = docs.mapInArrow(partial(_score, model=model), out)
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return rows.select(original_id(), "held_out", "n_tokens", "n_known", F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score", perplexity.alias("perplexity"))


def train_and_score(docs: DataFrame, folds: int = 7, fold: int = 2, **settings) -> DataFrame:
    """Learn from documents whose crc32(doc_id as text) mod ``folds`` is not ``fold``; score all.

    Tokens: runs of bytes other than space and 0x09-0x0D, A-Z lowered, then one end token. Null and
    empty texts are the end token alone. A null doc_id is never held out. Repeated rows count each.
    Other columns are ignored. Empty table: empty result. If all are held out, every token is unknown.
    """
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    keyed = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), F.coalesce(remainder == fold, F.lit(False)).alias("held_out")
    )
    keyed = key_and_text(keyed, "held_out")
    model = train(keyed.where(~F.col("held_out")), **settings)
    return score(keyed, model)
