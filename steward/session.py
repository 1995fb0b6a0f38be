"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every operator assumes. Memory, parallelism and the master stay with the deployment.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Call sites are only recorded for error messages and make building a plan several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app_name: str = "steward", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the settings the operators assume.

    Extra settings use double underscores for dots, e.g. ``spark__sql__shuffle__partitions="4000"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in REQUIRED_CONF.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def is_local(master: str) -> bool:
    """Whether the driver is the only executor, so that its folders are everybody's."""
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made only where the one machine is all there is; on a cluster, where each executor would write
    to its own disk and the result be incomplete, a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="steward-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`scratch_root`; nothing is created there yet."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to, and read from, the shared scratch folder: for what is used several times or must not change.

    The files stay, since the result and what is derived from it read them; clear the folder as its owner sees fit.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_scratch(df: DataFrame) -> None:
    """Remove the scratch files that ``df`` reads; it, and what is derived from it, cannot be read after that."""
    spark = df.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    inside = files.makeQualified(root).toString().rstrip("/") + "/"
    for name in {file.rpartition("/")[0] for file in df.inputFiles()}:
        folder = files.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(name))
        if folder.toString().startswith(inside):
            files.delete(folder, True)
