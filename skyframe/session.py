"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "skyframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Lookup tables are never broadcast by hint: Spark compares their measured size with
    the broadcast threshold below and joins by shuffle, with skew splitting, beyond it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are UTC instants throughout; a session in another zone would shift them."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let Python workers started from now on find this package where the driver found it."""
    environment = spark.sparkContext.environment
    root, paths = str(Path(__file__).resolve().parents[1]), environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="skyframe-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, label: str, root: str | None = None) -> str:
    return f"{(root or shared_dir(spark)).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts lineage like a checkpoint, but the result also carries true file sizes, so
    later joins against it are planned on what it measures.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files that ``df``, as given by ``materialise``, was written to.

    For tables that nothing reads any more. Needs a classic session (it goes through Hadoop's
    file system in the JVM, which reaches every shared folder Spark does).
    """
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
