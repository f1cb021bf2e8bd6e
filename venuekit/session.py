"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Engine settings the operators rely on. The shuffle width is the session's own: set it to the size of the input.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # no call-site capture on every column operation: it dominates the time to build wide expressions
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

#: whether the shuffle files of a query go when it ends
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app_name: str = "venuekit", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's settings; keyword keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, by one rule on every master.

    ``spark.checkpoint.dir`` if it is set, else a folder in the warehouse. A warehouse on a machine's own disk is shared with
    executors only where these run on that machine; elsewhere the caller has to name a folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    scheme = warehouse.split(":", 1)[0] if ":" in warehouse else "file"
    if scheme == "file" and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors reach: the warehouse {warehouse} is local")
    return warehouse + "/_venuekit"


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the work folder that no other run uses."""
    return f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write once and read back: reused results survive the loss of executors, unlike cached blocks.

    The shuffle files of the write go when it ends: else they stay until the driver happens to collect its garbage.
    ``discard`` removes the files when nothing derived from the frame will run again.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_path = path
    return stored


def discard(*frames: DataFrame) -> None:
    """Remove the folders of frames that came from ``materialize``; other frames are left alone."""
    for frame in frames:
        path = getattr(frame, "_stored_path", None)
        if path:
            spark = frame.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
