"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Rows in a file of a staged table. A scan packs files by bytes and counts 4 MB more for each, so its
# tasks get at most 32 of them; 128 MB of well compressed rows may be fifty times as much in memory.
FILE_ROWS = 50_000


def local_session(name: str = "matchwright", cores: int | str = 8) -> SparkSession:
    """A session for one machine; on a cluster the caller brings their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in LOCAL_SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session on one machine may go without the setting; it then gets a temporary folder.
    On a cluster a missing setting is an error, because a machine-local folder would be lost
    together with the executor that wrote it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="matchwright-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for staging files below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/matchwright/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute once, store in the shared folder and cut the lineage.

    Used where several readers would otherwise repeat the same shuffles, and between the rounds
    of an iteration. The copy survives the loss of executors.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Written once as Parquet in the shared folder and read back.

    Like ``materialize``, but columnar and with sizes that the optimizer knows, for frames that
    several steps read or that may turn out small enough for Spark to broadcast. Files have a bounded
    number of rows, so that a task doesn't get more of them the better they are compressed.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
