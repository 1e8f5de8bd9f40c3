"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


FORCE_SKEW = "spark.sql.adaptive.forceOptimizeSkewedJoin"
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")  # bytes of code beyond which the JVM never compiles a method


def ensure_skew_handling(spark: SparkSession) -> None:
    """Let adaptive execution split a hot key even where that costs one more shuffle.

    Without this a join whose result is grouped or joined again on the same key is left as it is,
    and all rows of a hot key stay in one task. The shuffle is only added when skew is found.
    """
    spark.conf.set(FORCE_SKEW, "true")


def ensure_compiled_methods(spark: SparkSession) -> None:
    """Keep the code that Spark generates for wide projections below the size that the JVM compiles.

    By default Spark makes one method of a stage's whole projection, and a table of twenty derived text columns
    runs interpreted. Beyond this limit the expressions become methods of their own.
    """
    spark.conf.set(*METHOD_LIMIT)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session with the settings every job here relies on.

    On a cluster the master, memory and shuffle width come from spark-submit; only the
    UTC time zone and adaptive execution matter for correctness and skew handling.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName("tributary")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(FORCE_SKEW, "true")
        .config(*METHOD_LIMIT)
        .config("spark.ui.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder reliable checkpoints go to.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that one is used as it is. Only a
    ``local`` master, whose executors are the driver, may do without: it gets a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if not current:
            context.setCheckpointDir(named)
        return named
    if not current:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tributary-checkpoint-"))
        current = context.getCheckpointDir()
    return current


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, for tables and inputs a job writes on its way."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder, in whatever store the path names, if it is not there yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in whatever store the path names; none when there is no folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files of a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; false when another writer was first."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = file.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        stream = system.create(file, False)
    except Py4JJavaError as problem:
        if "FileAlreadyExistsException" in str(problem.java_exception.getClass().getName()):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it; nothing happens where there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a frame that several branches of a job read. Unlike a cache it survives lost executors,
    and each reader still prunes columns and pushes filters down. The shuffle files behind it are deleted as soon as it is
    written, since nothing reads them again; Spark would keep them until the driver collects its garbage.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)
