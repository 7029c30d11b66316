"""Session set-up and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", name: str = "lodestone", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a local master may fall back to a temporary folder: on a cluster such a
    folder is lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return active
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    fallback = tempfile.mkdtemp(prefix="lodestone-")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables, under the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/lodestone-{spark.sparkContext.applicationId}"


#: Shuffle files of a statement go when it ends, rather than when the driver collects garbage.
SHUFFLE_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def durable(df: DataFrame, label: str, *more: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, with the rows of ``more``.

    Each of them is a statement of its own, whose shuffle files are gone before the next one starts.

    Used where several later steps read one costly table: it is computed once, a
    lost executor loses none of it, and readers prune its columns. ``discard`` drops
    one such table, ``clean_up`` all of the application. ``compression`` is the files' codec, else the session's.
    """
    options = {"compression": compression} if compression else {}
    path, conf = f"{run_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}", df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEAN_UP, "false")
    conf.set(SHUFFLE_CLEAN_UP, "true")
    try:
        for part in (df, *more):
            part.write.mode("append").options(**options).parquet(path)
    finally:
        conf.set(SHUFFLE_CLEAN_UP, before)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.durable_path = path
    return table


def durable_small(df: DataFrame, label: str, *more: DataFrame) -> DataFrame:
    """``durable`` in fewer bytes for some more work, for tables that are on disk next to many others."""
    return durable(df, label, *more, compression="zstd")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``durable`` returned and that no later step reads."""
    for table in tables:
        path = getattr(table, "durable_path", None)
        if path:
            _delete(table.sparkSession, path)


def clean_up(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application. Call it when results are written."""
    _delete(spark, run_dir(spark))
