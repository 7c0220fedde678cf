"""Where intermediate tables go.

Loops cut their lineage with a written table, and streams need a checkpoint
and a target. All of these must outlive an executor, so they live in the
folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session: that of ``spark.checkpoint.dir``, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        # the warehouse is shared by its nature; a machine's own folder is not
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.pagedframes"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name that no other run uses; nothing is created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def full_name(spark: SparkSession, folder: str) -> str:
    """``folder`` with its file system, for tasks that open files by themselves."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What a write in this block has shuffled leaves the disks at its end, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def write_and_reopen(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` once and return the written table, whose plan is a plain scan."""
    with shuffles_released(df.sparkSession):
        df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
