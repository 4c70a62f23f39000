"""Session set-up, the shared folder and other things that touch the cluster."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "missiva", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine expects; settings given by the caller win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=settings).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and the master is local (tests, a laptop) a temporary folder takes its place.
    """
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir", None)
    if where is None:
        where = sc.getCheckpointDir()
    if where is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + os.path.join(tempfile.gettempdir(), f"missiva-{sc.applicationId}")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(where)
    return where


def cut(df: DataFrame, instead_of: DataFrame | None = None) -> DataFrame:
    """Cut the lineage with a table written into the shared folder; it survives the loss of executors.

    A written table, unlike a checkpointed plan, carries no constraints over into the next plan,
    which would grow with every round of a loop. instead_of: an earlier result of this function
    that nothing reads any more; its files are removed.
    """
    spark = df.sparkSession
    where = f"{shared_dir(spark).rstrip('/')}/missiva-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(where)
    out = spark.read.schema(df.schema).parquet(where)
    out._missiva_files = where
    if instead_of is not None:
        drop(instead_of)
    return out


def drop(df: DataFrame) -> None:
    """Remove the files behind a result of ``cut``."""
    where = getattr(df, "_missiva_files", None)
    if where:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
