"""Session helpers: settings the operators rely on, and the checkpoint folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results (time zone) or that skewed plans need (adaptive joins).
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A union of equally partitioned inputs must not pass for partitioned: aggregates above it came out unmerged.
    "spark.sql.unionOutputPartitioning": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, app: str = "corpusloom", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**REQUIRED, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; only a local session may do without one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    local = context.master.startswith("local") and not context.master.startswith("local-cluster")
    if not named and not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="corpusloom-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back, so lost executors cost nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


FORGET_SECONDS = 4.0  # between two collections of the driver's JVM, so that short rounds are not slowed down
_forgot = 0.0


def forget(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of results that nothing refers to any more.

    Spark deletes them when the driver's JVM collects the plans they belong to. A driver that holds little seldom collects, and the files
    of all rounds of a loop lie on the executors' disks at once.
    """
    global _forgot
    if time.monotonic() - _forgot < FORGET_SECONDS:
        return
    gc.collect()
    spark._jvm.System.gc()
    _forgot = time.monotonic()


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back; the shuffle files it took are deleted.

    A checkpoint keeps the size estimates of its plan. In a loop that joins its own result several times a round they
    multiply, and planning takes longer than the work; files have their true size.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    forget(df.sparkSession)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def replaced(*settled: DataFrame | None) -> None:
    """Deletes the files of settled results that nothing reads any more; others and None are left alone."""
    for df in settled:
        path = vars(df).pop("settled_at", None) if df is not None else None
        if path is not None:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
