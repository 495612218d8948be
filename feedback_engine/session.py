"""Session settings the engine relies on, and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results (zone) or how large shuffles behave (the rest).
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "feedback_engine", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a session that says it runs within one process (``local[...]``) gets a
    temporary folder where none is named; any other must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="feedback_engine-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_workspace(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder name under the shared folder (never reused)."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folders(spark: SparkSession, *paths: str) -> None:
    """Remove folders of intermediate results, on whatever file system they are."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
