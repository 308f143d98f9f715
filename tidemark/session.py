"""Session settings and the shared folder that written intermediate results go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def local_session(cores: str = "8", app: str = "tidemark", **settings: str) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        # Tables that are loaded side by side share the cores; a cluster sets this itself.
        .config("spark.scheduler.mode", "FAIR")
        # The JVM does not compile methods above 8000 bytes; wide projections exceed that.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Without the Python call site of every expression, wide plans are built twice as fast.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session may do without the setting: it gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(folder)
        _local_folders[context.applicationId] = folder
    return _local_folders[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write a frame to the shared folder and read it back: later passes see the same
    rows, scan only the columns they need, and survive the loss of an executor."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
