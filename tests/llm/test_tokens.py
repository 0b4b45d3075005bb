from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from slotwise.llm import bpe
from slotwise.llm.lengths import at_limit, length_at, length_histogram, limits
from slotwise.llm.text import text_bytes
from slotwise.llm.tokens import pack_blocks, read_token_ids, segment, segments, token_digests, unpack_blocks, write_token_files

TOOL = None


def ids_of(text):
    global TOOL
    if TOOL is None:
        from tokenizers import Tokenizer

        TOOL = Tokenizer.from_file(bpe.vocabulary_path())
    return TOOL.encode(text or "", add_special_tokens=False).ids


def order(doc_id):
    return (doc_id is None, doc_id or 0)


def compare(df, **settings):
    got = sorted(token_digests(df, **settings).collect(), key=lambda r: r["start"])
    want = []
    for r in df.select("doc_id", "text").collect():
        ids = [*ids_of(r["text"]), 0]
        want.append((r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    assert [r["doc_id"] for r in got] == sorted((w[0] for w in want), key=order)
    key = lambda w: (order(w[0]), w[1:])
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)


def test_files_hold_the_ids(docs):
    compare(docs, bucket_mb=0.1, segment_ids=5_000)


def test_odd_rows(odd):
    compare(odd, bucket_mb=0.3)


def test_pieces_and_special_tokens(spark):
    texts = ["a  b  c it's we'll,ok!\n\n x   y <|endoftext|> z", "é   　 x, 'stuff don't 12.5% \x1c q \x85 r", "Éa ", " lead   x  w é  ", "", "x  y", "a  b"]
    compare(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_empty_table(empty):
    assert token_digests(empty).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5_000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    for top in (1, 2, 300, 50_257, 2**32 - 1):
        ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
        for percentile in (0.5, 0.95, 1.0):
            assert (unpack_blocks(*pack_blocks(ids, percentile), n) == ids).all()
    ids = np.zeros(n, np.uint32)
    ids[::97] = 2**31
    index, body = pack_blocks(ids)
    assert (unpack_blocks(index, body, n) == ids).all() and len(body) < 4 * n + 1


def test_segments_are_read_in_order():
    one = segment(1, np.array([5, 6]), np.array([2, 1]), np.array([7, 0, 0], np.uint32))
    zero = segment(0, np.array([1]), np.array([3]), np.array([9, 9, 0], np.uint32))
    got = list(segments(one + b"\n" + zero + b"\n"))
    assert [g[0] for g in got] == [0, 1]
    assert got[1][1].tolist() == [5, 6] and got[1][3].tolist() == [7, 0, 0]
    with pytest.raises(ValueError):
        list(segments(b"something else"))


def test_ids_come_back(docs, rows, tmp_path):
    write_token_files(docs, str(tmp_path / "tokens"))
    got = {r["doc_id"]: r["ids"] for r in read_token_ids(docs.sparkSession, str(tmp_path / "tokens")).collect()}
    assert all(got[d] == [*ids_of(t), 0] for d, t in rows[:50]) and len(got) == len(rows)


def test_a_full_cache_starts_anew(rows, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 300)
    import pyarrow as pa

    from slotwise.llm.text import text_bytes

    tool = bpe.PieceEncoder(bpe.vocabulary_path())
    for _, text in rows[:30]:
        ids, count = tool.encode(*text_bytes(pa.array([text])))
        assert ids.tolist() == ids_of(text) and count.tolist() == [len(ids)]


def test_histogram_answers_every_limit(docs, rows):
    lengths = np.array([len(ids_of(t)) for _, t in rows])
    answers = limits(length_histogram(docs))
    for r in answers.collect():
        n = r["length"]
        assert r["docs"] == (lengths == n).sum() and r["docs_within"] == (lengths <= n).sum()
        assert r["docs_longer"] == (lengths > n).sum() and r["tokens_longer"] == lengths[lengths > n].sum()
        assert r["truncated_tokens"] == np.minimum(lengths, n).sum()
        assert r["quantile"] == pytest.approx((lengths <= n).mean())
    for limit in (0, 1, 100, 777, 10**6):
        r = at_limit(answers, limit).first()
        assert r["truncated_tokens"] == np.minimum(lengths, limit).sum() and r["docs_within"] == (lengths <= limit).sum()
    assert length_at(answers, 0.5).first()[0] == np.sort(lengths)[(len(lengths) - 1) // 2]


def test_histogram_of_odd_rows(odd, empty):
    got = {r["length"]: r["docs"] for r in length_histogram(odd).collect()}
    assert got[0] == 2 and sum(got.values()) == odd.count()
    assert limits(length_histogram(empty)).count() == 0
    assert at_limit(limits(length_histogram(empty)), 5).first()["truncated_tokens"] == 0


def test_an_id_with_many_rows_fills_several_files(spark, tmp_path):
    rows = [(None if i % 3 else i, f"text {i} " * (1 + i % 40)) for i in range(1500)] + [(7, f"seven {i} " * 30) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    compare(df, bucket_mb=0.02)
    write_token_files(df, str(tmp_path / "tokens"), bucket_mb=0.02)
    sizes = [sum(f.stat().st_size for f in d.iterdir()) for d in (tmp_path / "tokens").iterdir() if d.is_dir()]
    assert len(sizes) > 20 and max(sizes) < 8 * sorted(sizes)[len(sizes) // 2]


def test_new_pieces_share_calls_of_the_library(monkeypatch):
    tool, given = bpe.PieceEncoder(bpe.vocabulary_path()), []
    whole = tool._whole
    monkeypatch.setattr(tool, "_whole", lambda texts: given.extend(texts) or whole(texts))
    words = [f"{chr(97 + i % 26)}x{i}é" for i in range(500)]
    texts = [" ".join(words), "  ", "", "a\n\n b's  c ", "0" * 50]
    buffer, offsets = text_bytes(pa.array(texts))
    ids, count = tool.encode(buffer, offsets)
    assert count.tolist() == [len(ids_of(t)) for t in texts]
    assert ids.tolist() == [x for t in texts for x in ids_of(t)]
    assert len(given) <= 1 + 520 // 20
