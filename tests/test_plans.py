"""The plans that matter at scale keep their shape."""

from __future__ import annotations

import pytest

from slotwise.ml.scoring import scoring_features
from slotwise.operators import features, rows
from slotwise.plans import canonical
from slotwise.session import build_session, scratch_dir
from slotwise.sources.snapshots import snapshots_between

SF = "/root/testdata/sf0.001"


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_feature_build_moves_wide_rows_once(spark):
    plan = plan_of(features.all_features(canonical.raw_snapshots(spark, SF)))
    assert plan.count("FileScan") == 2
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    # keep-last of the wide and of the narrow rows, the narrow series, and its result
    assert len(moves) == 4
    assert plan.count("ReusedExchange") == 3
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan and "Pandas" not in plan


def test_narrow_branch_reads_only_its_columns(spark):
    plan = plan_of(features.series_features(rows.keep_last(canonical.raw_snapshots(spark, SF))))
    for schema in plan.split("ReadSchema: ")[1:]:
        assert "props" not in schema.split("\n")[0]


def test_date_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "flat")
    canonical.snapshots(spark, SF).write.parquet(path)
    df = snapshots_between(spark.read.parquet(path), "2024-01-10", "2024-01-11").select("dock_bikes")
    plan = plan_of(df)
    assert "GreaterThanOrEqual(snapshot_timestamp" in plan and "LessThan(snapshot_timestamp" in plan
    assert "ReadSchema: struct<dock_bikes:int,snapshot_timestamp:timestamp>" in plan


def test_scratch_folder_comes_from_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(shared)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_user_settings_survive(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    build_session()
    assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("name", ["spark.sql.session.timeZone"])
def test_session_is_utc(spark, name):
    assert spark.conf.get(name) == "UTC"


def test_scoring_windows_start_from_written_rows(spark):
    """The cut of the history is not repeated, with its sorts, in each branch of the stage that holds the windows."""
    flat = canonical.snapshots(spark, SF)
    plan = plan_of(scoring_features(flat.where("hour(snapshot_timestamp) = 0"), flat, canonical.AS_OF))
    assert "LeftSemi" not in plan and "Union" not in plan
