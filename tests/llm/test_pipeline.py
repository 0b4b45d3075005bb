from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import __spark_entry__ as entry_module  # noqa: E402
import corpus_pipeline  # noqa: E402

from .conftest import SF  # noqa: E402
from .test_nearcopies import by_distance  # noqa: E402
from slotwise.llm.decontaminate import contamination  # noqa: E402
from slotwise.llm.queries import LLM_QUERIES  # noqa: E402
from slotwise.session import materialise  # noqa: E402

COLUMNS = {
    "op1": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op2": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op3": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op4": ["doc_id", "held_out", "score", "predicted"],
    "op5": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op6": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op7": ["page_id", "lang"],
    "op8": ["length", "docs"],
    "op9": ["doc_id", "size", "source_size", "target", "taken"],
    "op10": ["doc_id", "fingerprint", "component_id"],
    "op11": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op12": ["word", "form", "root", "n", "n_near", "form_n"],
    "op13": ["page_id", "url", "text", "n_chars"],
}


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_every_query_runs_over_its_table(spark, name):
    assert name in entry_module.queries()
    df = LLM_QUERIES[name](spark, SF)
    want = COLUMNS[name.split("_")[0]]
    assert df.columns[: len(want)] == want
    rows = df.count()
    if want[0] == "doc_id":
        assert rows == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert rows > 0


def test_stages_take_effect(spark, docs):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = materialise(stage(spark, before, SF), name)
        assert kept.columns == docs.columns
        if name == "simhash_near_dedup":
            assert sorted(r["doc_id"] for r in kept.collect()) == by_distance([(r["doc_id"], r["text"]) for r in before.collect()])
        if name == "decontamination":
            found = contamination(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert kept.count() == found.where("n_hit = 0").count()
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert last.count() == kept.count()
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, again.collect()))


def test_empty_table(spark, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_odd_rows_through_all_stages(spark, odd, tmp_path):
    """Nulls, empty and repeated rows, one very long text and clashing column names: stage by stage, and as a whole."""
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    kept = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialise(stage(spark, kept, str(tmp_path)), name)
        assert sorted(kept.columns) == sorted(odd.columns)
    last = corpus_pipeline.run(spark, str(tmp_path))
    assert last.count() == kept.count() > 0
    starts = sorted((r["start"], r["n_tokens"]) for r in last.collect())
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
