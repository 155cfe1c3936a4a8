"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

#: Settings that hold for every job, at any size. Partition counts are left to AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a generated method above 8000 bytes is not compiled to machine code, which wide rows of 35 to 50 cells reach;
    # beyond it Spark generates one smaller class per operator instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # collect_set over days keeps small buffers, so hash aggregation can hold more keys before it sorts
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def build_session(app: str = "rosterlake", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the defaults above; ``extra`` uses ``__`` for the dots of a key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def settle(spark: SparkSession) -> None:
    """The settings that results and running times depend on, for a session that somebody else has made."""
    for key in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(key, DEFAULTS[key])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names. Where none is set and driver and executors are one process, as in
    tests, a folder is made once for the session; on a cluster it must be set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(os.path.join(tempfile.mkdtemp(prefix="rosterlake-"), "checkpoints"))
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from the written rows, so that a lost executor costs no rerun."""
    spark = df.sparkSession
    wanted = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(wanted)
    return df.checkpoint(eager=True)


def observed(observation: Observation, name: str = "n") -> int:
    """A count that was taken while a query ran. Where nothing at all came through, the query may have been cut short together
    with what observes it; Spark then has no row of metrics."""
    try:
        return observation.get[name]
    except Py4JJavaError as error:
        if "java.lang.AssertionError" in str(error.java_exception):
            return 0
        raise


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table to the shared folder and go on from there. Unlike a checkpoint this is a query that ends, so
    that what ``df`` observes is known afterwards."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
