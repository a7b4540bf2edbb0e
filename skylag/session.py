"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BLOCK_BYTES = 8 << 20  # row groups of stored tables: the least that a later pass may hand to a task


def local_session(app: str = "skylag", cpus: int | str = 8, memory: str = "16g") -> SparkSession:
    """A session for tests, benches and laptops; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only when that setting
    and the context's own checkpoint folder are both unset and all runs in one
    process (tests, laptops) a fresh local folder is chosen; a cluster without
    a shared folder is refused, for its executors see only their own disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named is None and context.getCheckpointDir() is None and not context.master.startswith("local["):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="skylag-ckpt-"))
    return named or context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder once and read it from there.

    For steps that pass over the same derived rows several times: later passes
    read only the columns they need and never repeat the work behind them.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("parquet.block.size", BLOCK_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table that ``materialise`` stored, once nothing reads it any more.

    The driver's collector then runs, for Spark keeps the shuffle files of finished writes until it does.
    """
    spark = df.sparkSession
    for folder in {os.path.dirname(file) for file in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    spark._jvm.System.gc()
