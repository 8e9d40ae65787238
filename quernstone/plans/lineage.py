"""Cutting a plan's lineage with a table in the folder that all executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for checkpoints; one of our own only in a local session that names none.

    On a cluster every executor would write to its own disk, so a missing setting is an error there.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"{SETTING} must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="quernstone-")
        spark.sparkContext.setCheckpointDir(folder)
        atexit.register(_remove, folder)
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def _remove(folder: str) -> None:
    import shutil

    shutil.rmtree(folder.removeprefix("file://"), ignore_errors=True)


class Cut:
    """A DataFrame written as Parquet, to be read any number of times and dropped when done with, or at the driver's exit."""

    def __init__(self, df: DataFrame, name: str) -> None:
        self.spark = df.sparkSession
        self.path = f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.schema = df.schema
        df.write.option("compression", "zstd").parquet(self.path)
        self._file_system().deleteOnExit(self._path())

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        self._file_system().delete(self._path(), True)

    def _path(self):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)

    def _file_system(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())


def cut(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table; a lost executor costs no recomputation before it."""
    return Cut(df, name).read()
