"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job expects; all can be changed on a live session.
#   timeZone            calendar attributes and date keys are defined in UTC
#   skewJoin            one hot key may hold a third of a table: AQE cuts its
#                       shuffle partition into several tasks on the join's row side
#   forceOptimize...    do that even when a later aggregate then needs one more shuffle
#   partitionOverwrite  a full load may only replace the tenants it brings
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Parquet bytes a map task reads at most: it unfolds and sorts them in memory.
MAP_BYTES = 32 << 20


def _bytes(spark: SparkSession, setting: str) -> int:
    value = spark.conf.get(setting)
    if value.lstrip("-").isdigit():
        return int(value)
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(value)


def apply_settings(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """``shuffle_partitions`` bounds what one task of an aggregation or a window holds: take
    the bytes of the largest shuffle over 200 MB.  Adaptive execution joins small ones again."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    if _bytes(spark, "spark.sql.files.maxPartitionBytes") > MAP_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(MAP_BYTES))
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def local_session(cores: int | str = "*", app: str = "storelake", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)


def _scratch_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, else one below the warehouse: both are
    reached by all executors."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder for tables written inside one job."""
    return f"{_scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _at(spark: SparkSession, path: str):
    """A path, and the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, folder: str, before_ms: int | None = None) -> list[str]:
    """Names in a folder (none if it is missing), on request only of entries last changed before a time."""
    target, files = _at(spark, folder)
    if not files.exists(target):
        return []
    found = files.listStatus(target)
    return [f.getPath().getName() for f in found if before_ms is None or f.getModificationTime() < before_ms]


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    target, files = _at(spark, path)
    return files.getContentSummary(target).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    target, files = _at(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file as a whole under a name that must be free; False if it is taken."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, files = _at(spark, path)
    draft = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(target), no_overwrite)
    except Py4JJavaError as problem:
        files.delete(draft, False)
        if problem.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A scratch folder that is gone after the block."""
    path = scratch_path(spark, purpose)
    try:
        yield path
    finally:
        remove(spark, path)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Cut the lineage: store ``df`` in the shared scratch folder and read it back."""
    return sized(df, purpose)[0]


def sized(df: DataFrame, purpose: str) -> tuple[DataFrame, bool]:
    """The same, and whether the stored rows are below Spark's broadcast limit."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    small = size_of(spark, path) <= _bytes(spark, "spark.sql.autoBroadcastJoinThreshold")
    return spark.read.schema(df.schema).parquet(path), small
