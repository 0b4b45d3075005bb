from __future__ import annotations

import json
from datetime import date, timedelta

import pytest
from conftest import row, series, ts
from pyspark.sql import functions as F
from test_sources import document, station

from slotwise import schemas
from slotwise.ml import model as trees
from slotwise.ml.scoring import score_slots
from slotwise.operators import features, monitoring, rows
from slotwise.operators.rows import with_target
from slotwise.operators.split import temporal_split
from slotwise.plans.queries import QUERIES
from slotwise.session import materialise
from slotwise.sources.snapshots import read_raw_snapshots
from slotwise.sources import sinks
from slotwise.sources.tables import first_retained, read_dated, read_predictions, read_table
from slotwise.streaming import cycle


def finish(query):
    query.awaitTermination(180)
    assert query.exception() is None and not query.isActive


def dirs(tmp_path, *names):
    return [str(tmp_path / n) for n in names]


def test_ingest_continues_where_it_stopped(spark, tmp_path):
    landing, table, checkpoint = dirs(tmp_path, "landing", "table", "checkpoint")
    (tmp_path / "landing").mkdir()
    for i, at in enumerate(["2024-01-15T09:00:00+00:00", "2024-01-15T09:15:00+00:00"]):
        (tmp_path / "landing" / f"{i}.json").write_text(json.dumps(document(at, [station(1), station(2)])))
        stream = cycle.ingest_stream(cycle.document_stream(spark, landing))
        finish(cycle.start_table(stream, table, checkpoint))
        assert spark.read.parquet(table).count() == 2 * (i + 1)
    batch = read_raw_snapshots(spark, landing)
    assert spark.read.parquet(table).drop("dt").exceptAll(batch).count() == 0


def test_dedup_drops_redelivered_slots(spark, frame, tmp_path):
    landing, table, checkpoint = dirs(tmp_path, "landing", "table", "checkpoint")
    data = frame(series(1, "2024-01-15 09:00:00", range(8)))
    for _ in range(2):
        data.coalesce(1).write.mode("append").parquet(landing)
    stream = cycle.table_stream(spark, landing, data.schema, maxFilesPerTrigger=1)
    finish(cycle.start_table(cycle.dedup_stream(stream), table, checkpoint))
    assert spark.read.parquet(table).count() == 8


@pytest.fixture(scope="module")
def errors(spark):
    start = ts("2024-01-15 09:00:00")
    predicted = [(s, start + timedelta(minutes=15 * i), start + timedelta(minutes=15 * i + 60), float(i % 7), "v1") for s in (1, 2) for i in range(150)]
    observed = [(s, start + timedelta(minutes=15 * i), i % 5) for s in (1, 2) for i in range(150)]
    return (
        spark.createDataFrame(predicted, schemas.PREDICTIONS),
        spark.createDataFrame(observed, "id long, ingestion_timestamp timestamp, dock_bikes int"),
    )


def test_stream_join_equals_batch(spark, errors, tmp_path):
    p, o, out, checkpoint = dirs(tmp_path, "p", "o", "out", "checkpoint")
    errors[0].write.parquet(p)
    errors[1].write.parquet(o)
    pairs = cycle.matched_stream(
        cycle.table_stream(spark, p, errors[0].schema), cycle.table_stream(spark, o, errors[1].schema)
    )
    finish(cycle.start_table(pairs, out, checkpoint, time=None))
    got = spark.read.parquet(out).select("station_id", "target_time", "error")
    want = monitoring.matched_errors(*errors).select("station_id", "target_time", "error")
    assert got.count() == want.count() == 2 * 146
    assert got.exceptAll(want).count() == 0


@pytest.mark.parametrize(("window", "slide"), [("1 day", None), ("6 hours", "15 minutes")])
def test_closed_windows_equal_batch(spark, errors, tmp_path, window, slide):
    cycles = monitoring.cycle_metrics(*errors, rows.instant("2024-01-20")).select("cycle_timestamp", "mae")
    src, out, checkpoint = dirs(tmp_path, "src", "out", "checkpoint")
    cycles.write.parquet(src)
    stream = cycle.error_windows(cycle.table_stream(spark, src, cycles.schema), window, slide)
    finish(cycle.start_table(stream, out, checkpoint, time=None))
    got = {r["window_start"]: (r["n_cycles"], round(r["avg_mae"], 9)) for r in spark.read.parquet(out).collect()}
    w = F.window("cycle_timestamp", window, slide) if slide else F.window("cycle_timestamp", window)
    batch = cycles.groupBy(w.alias("w")).agg(F.count("*").alias("n"), F.avg("mae").alias("m"))
    closed = cycles.agg(F.max("cycle_timestamp")).first()[0] - timedelta(hours=1)
    want = {r["w"]["start"]: (r["n"], round(r["m"], 9)) for r in batch.collect() if r["w"]["end"] <= closed}
    assert got == want and got


def scored_model(frame):
    history = frame(series(1, "2024-01-01 00:00:00", [3, 9, 15] * 32 * 5))
    data = materialise(with_target(features.all_features(history)), "stream-features")
    train, val, _ = temporal_split(data)[:3]
    return trees.train_model(train, val, {"maxIter": 1, "maxDepth": 2}), history


def test_scoring_stream_equals_batch_and_repeats_safely(spark, frame, tmp_path):
    landing, out, checkpoint, table = dirs(tmp_path, "landing", "out", "checkpoint", "table")
    model, history = scored_model(frame)
    history.withColumn("dt", F.to_date("snapshot_timestamp")).write.partitionBy("dt").parquet(table)
    asked = []
    stored = cycle.table_history(spark, table, history.schema)

    def read_history(first, last):
        asked.append((str(first), str(last)))
        return stored(first, last)

    data = [row(1, ts("2024-01-06 00:00:00"), 3), row(1, ts("2024-01-06 00:15:00"), 9), row(2, ts("2024-01-06 00:15:00"), 4, no_available=1)]
    fresh = frame(data).withColumn("raw_ts", F.col("snapshot_timestamp") + F.expr("INTERVAL '7' MINUTE"))
    fresh.coalesce(1).write.parquet(landing)
    stream = cycle.table_stream(spark, landing, fresh.schema)
    finish(cycle.start_scoring(stream, read_history, model, "v1", out, checkpoint))
    got = read_predictions(spark, out)
    want = score_slots(model, "v1", fresh, history)
    assert got.count() == 2 and got.exceptAll(want).count() == 0
    assert asked == [("2023-12-29", "2024-01-06")]
    made = sorted(r["prediction_made_at"] for r in got.collect())
    assert made == [ts("2024-01-06 00:07:00"), ts("2024-01-06 00:22:00")]
    assert (tmp_path / "out" / "dt=2024-01-06").is_dir()
    # another checkpoint, more files, and a row that is delivered again
    extra = frame([row(1, ts("2024-01-06 00:30:00"), 5), data[1]]).withColumn("raw_ts", F.col("snapshot_timestamp") + F.expr("INTERVAL '7' MINUTE"))
    extra.coalesce(1).write.mode("append").parquet(landing)
    for again in ("again", "once more"):
        finish(cycle.start_scoring(stream, read_history, model, "v1", out, str(tmp_path / again)))
        assert read_predictions(spark, out).count() == 3
    finish(cycle.start_scoring(stream, read_history, model, "v2", out, str(tmp_path / "v2")))
    assert {tuple(r) for r in read_predictions(spark, out).groupBy("model_version").count().collect()} == {("v1", 3), ("v2", 3)}


def test_a_scoring_batch_that_failed_half_way_is_completed(spark, frame, tmp_path):
    landing, out, checkpoint = dirs(tmp_path, "landing", "out", "checkpoint")
    model, history = scored_model(frame)
    fresh = frame([row(s, ts("2024-01-06 00:00:00"), 3) for s in range(1, 9)])
    fresh.coalesce(1).write.parquet(landing)
    want = score_slots(model, "v1", fresh, history)
    sinks.append_predictions(want.where("station_id < 4"), out)  # what a lost run had written
    stream = cycle.table_stream(spark, landing, fresh.schema)
    finish(cycle.start_scoring(stream, lambda first, last: history, model, "v1", out, checkpoint))
    got = read_predictions(spark, out)
    assert got.count() == 8 and got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_reconciled_cycles_equal_batch_whatever_the_order(spark, errors, tmp_path):
    predictions, observed = errors
    stored, seen, cycles, checkpoint = dirs(tmp_path, "stored", "seen", "cycles", "checkpoint")
    schema = "id long, ingestion_timestamp timestamp, dock_bikes int, raw_ts timestamp"
    empty = spark.createDataFrame([], schema)

    def land(df, arrived):
        dated = df.withColumn("raw_ts", rows.instant(arrived)).withColumn("dt", F.to_date("ingestion_timestamp"))
        dated.write.mode("append").partitionBy("dt").parquet(seen)

    def run(folder=checkpoint, at="2024-01-20"):
        finish(
            cycle.start_reconcile(
                cycle.table_stream(spark, stored, schemas.PREDICTIONS),
                cycle.table_stream(spark, seen, empty.schema),
                cycle.table_history(spark, stored, schemas.PREDICTIONS),
                cycle.table_history(spark, seen, empty.schema),
                cycles,
                folder,
                reconciled_at=rows.instant(at),
            )
        )
        return monitoring.current_cycles(read_table(spark, cycles, schemas.CYCLE_METRICS)).drop("reconciled_at")

    def batch():
        p, o = spark.read.parquet(stored).drop("dt"), spark.read.parquet(seen).drop("dt")
        return monitoring.cycle_metrics(p, o, rows.instant("2024-01-20")).drop("reconciled_at")

    def same(one, two):
        one, two = (sorted(tuple(r) for r in df.select(*schemas.CYCLE_METRICS.fieldNames()[:-1]).collect()) for df in (one, two))
        return one == two and len(one)

    land(observed.where("id = 1 AND ingestion_timestamp >= '2024-01-16'"), "2024-01-17")
    sinks.append_predictions(predictions.where("station_id = 1"), stored)
    early = same(run(), batch())
    assert early
    land(observed.withColumn("dock_bikes", F.col("dock_bikes") + 2), "2024-01-18")  # late, and again with other values
    assert same(run(), batch()) > early
    land(observed, "2024-01-19")
    assert sinks.append_new(predictions, stored, "predictions", "skip") == 150  # late predictions, the first ones again
    assert same(run(), batch()) == 146
    n = read_table(spark, cycles, schemas.CYCLE_METRICS).count()
    land(observed, "2024-01-19")  # nothing new: no cycle is written again
    assert same(run(), batch()) == 146
    assert same(run(str(tmp_path / "second"), "2024-01-21"), batch()) == 146
    assert read_table(spark, cycles, schemas.CYCLE_METRICS).count() == n


def test_stream_table_is_read_after_retention(spark, frame, tmp_path):
    landing, table, checkpoint = dirs(tmp_path, "landing", "table", "checkpoint")
    data = frame([r for day in ("01", "02", "03") for r in series(1, f"2024-01-{day} 09:00:00", range(4))])
    data.coalesce(1).write.parquet(landing)
    stream = cycle.table_stream(spark, landing, data.schema)
    finish(cycle.start_table(stream, table, checkpoint))
    assert read_dated(spark, table, data.schema).count() == 12 and first_retained(spark, table) is None
    assert sinks.drop_expired(spark, table, date(2024, 1, 4), days=2) == ["dt=2024-01-01"]
    assert first_retained(spark, table) == date(2024, 1, 2)
    left = read_dated(spark, table, data.schema)
    assert left.count() == 8 and left.drop("dt").exceptAll(data).count() == 0
    assert read_dated(spark, table, data.schema, "2024-01-01", "2024-01-02").count() == 4
    assert cycle.table_history(spark, table, data.schema)(date(2024, 1, 1), date(2024, 1, 9)).count() == 8
    more = frame(series(1, "2024-01-04 09:00:00", range(4)))  # the stream goes on after that
    more.coalesce(1).write.mode("append").parquet(landing)
    finish(cycle.start_table(stream, table, checkpoint))
    assert read_dated(spark, table, data.schema).count() == 12
    assert sinks.drop_expired(spark, table, date(2024, 1, 6), days=2) == ["dt=2024-01-02", "dt=2024-01-03"]
    assert read_dated(spark, table, data.schema).count() == 4
    assert sinks.drop_expired(spark, table, date(2024, 1, 6), days=2) == []


def test_stream_queries_without_a_row(spark, tmp_path):
    """All documents break the contract (as soon as each has a station that is not available), no window closes, nothing pairs."""
    at = "CAST('2024-01-15 09:00:00' AS TIMESTAMP_NTZ)"
    events = spark.range(3).selectExpr("id AS event_id", f"{at} AS ts", "id AS user_id", "'signup' AS event_type", "5.0D AS value", """'{"k": 5}' AS props""")
    for n, part in enumerate((events, events.limit(0))):
        part.write.parquet(str(tmp_path / f"{n}/events.parquet"))
        found = QUERIES["stream_ingest"](spark, str(tmp_path / str(n)))
        assert found.count() == 0 and {"station_id", "raw_ts", "snapshot_timestamp"} <= set(found.columns)
        assert not {"dt", "seq"} & set(found.columns)
        for name in ("stream_reconcile", "stream_error_windows"):
            assert QUERIES[name](spark, str(tmp_path / str(n))).count() == 0
