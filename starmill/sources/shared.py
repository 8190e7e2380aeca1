"""Tables written in the cluster's shared folder to cut lineage.

An executor can be lost at any time, so whatever is read twice and must not change in between
is written as a Parquet table under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode if unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="starmill-")
    return _local_dir


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def filesystem(spark: SparkSession, path: str):
    """The Hadoop path object for ``path`` and its file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop, fs = filesystem(spark, path)
    fs.delete(hadoop, True)


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its text in one step; False when there is one already.

    The text is written aside and renamed without overwriting, which file systems with atomic renames
    grant to one writer only.
    """
    jvm = spark.sparkContext._jvm
    hadoop, fs = filesystem(spark, path)
    target = fs.makeQualified(hadoop)
    fs.mkdirs(target.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_aside-{uuid.uuid4().hex}")
    stream = fs.create(aside)
    stream.write(bytearray(text.encode()))
    stream.close()
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(aside, target, how)
    except Py4JJavaError as error:
        fs.delete(aside, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None when there is none."""
    hadoop, fs = filesystem(spark, path)
    if not fs.exists(hadoop):
        return None
    stream = fs.open(hadoop)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path``."""
    hadoop, fs = filesystem(spark, path)
    return fs.getContentSummary(hadoop).getLength()


class Scratch:
    """Written intermediate tables; used as a context manager it drops them on leaving.

    Without ``with``, the tables stay in the shared folder for lazy readers.
    """

    def __init__(self, spark: SparkSession, label: str = "scratch"):
        self.spark = spark
        self.root = fresh_dir(spark, label)
        self._count = 0

    def table(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return a reader of what was written."""
        return self.sized_table(df)[0]

    def sized_table(self, df: DataFrame) -> tuple[DataFrame, int]:
        """``table`` and the bytes of its files."""
        self._count += 1
        path = f"{self.root}/t{self._count}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), size_of(self.spark, path)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        delete_path(self.spark, self.root)
