"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every plan here relies on; adaptive execution and ANSI mode stay at their Spark 4
# defaults (on). The second one lets a join whose keys include the station reuse data
# already hashed by station instead of moving it again. The third one gives up generated
# code for a stage whose method is too long for the JVM to compile; run as bytecode it is
# two to four times slower (the full feature projection is that long).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "slotwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables and stream checkpoints.

    It lies under ``spark.checkpoint.dir``, the folder all executors share. Only a local
    session without that setting falls back to the machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        base = os.path.join(tempfile.gettempdir(), "slotwise-scratch")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df, name: str):
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage at a point several later jobs start from, without keeping anything on
    an executor that may be lost.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
