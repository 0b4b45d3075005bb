"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the tables and cores. ``BENCH_REPLICATE=n`` times
the feature build and the cycle metrics on the events copied to ``n`` times as many
stations and three times as long a period instead (79 gives a production year).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.operators import features, monitoring
from slotwise.operators.rows import instant, keep_last
from slotwise.plans import canonical
from slotwise.plans.queries import QUERIES
from slotwise.session import build_session, materialise

HEADLINE = (
    "snapshots_keep_last",
    "lag_features",
    "temporal_features",
    "weather_features",
    "district_first_match",
    "historical_features",
    "all_features",
    "training_dataset",
    "naive_baseline_by_station",
    "evaluate_metrics",
    "critical_states",
    "latest_predictions",
    "prediction_lookup",
    "cycle_metrics",
    "station_daily_metrics",
    "daily_totals",
    "online_mae_view",
    "top10_worst_stations",
    "performance_alert",
    "ks_drift",
    "chi2_drift",
    "scoring_feature_rows",
)


def timed(df_of) -> float:
    start = time.perf_counter()
    df_of().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def replicated(raw: DataFrame, stations: int) -> DataFrame:
    """Each row once per station copy and 30-day period."""
    copies = raw.repartition(64).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(stations - 1))))
    copies = copies.withColumn("_p", F.explode(F.array(*[F.lit(p) for p in range(3)])))
    shift = F.col("_p") * F.expr("INTERVAL '30' DAY")
    return copies.withColumns(
        {
            "station_id": F.col("station_id") + F.col("_s") * 8,
            "snapshot_timestamp": F.col("snapshot_timestamp") + shift,
            "raw_ts": F.col("raw_ts") + shift,
        }
    ).drop("_s", "_p")


def year(spark, sf_dir: str, stations: int) -> dict[str, float]:
    raw = materialise(replicated(canonical.raw_snapshots(spark, sf_dir), stations), "year")

    def cycles() -> DataFrame:
        kept = keep_last(raw)
        made = F.col("snapshot_timestamp")
        predictions = kept.select(
            "station_id",
            (made + F.expr("INTERVAL '1' HOUR")).alias("target_time"),
            (F.col("dock_bikes") * 1.0).alias("predicted_dock_bikes"),
            F.lit("v1").alias("model_version"),
        )
        seen = kept.select(
            F.col("station_id").alias("id"), made.alias("ingestion_timestamp"), "dock_bikes"
        )
        return monitoring.cycle_metrics(predictions, seen, instant(canonical.AS_OF))

    return {
        "scan": timed(lambda: raw),
        "keep_last": timed(lambda: keep_last(raw)),
        "all_features": timed(lambda: features.all_features(raw)),
        "cycle_metrics": timed(cycles),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    stations = int(os.environ.get("BENCH_REPLICATE", "0"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": os.environ.get("BENCH_PARTITIONS", cpus),
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed(lambda: QUERIES["lag_features"](spark, sf_dir))  # start-up is not a query
    if stations:
        seconds = year(spark, sf_dir, stations)
    else:
        seconds = {name: timed(lambda: QUERIES[name](spark, sf_dir)) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
