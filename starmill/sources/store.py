"""Versioned Parquet tables.

A table is a folder of versions ``v=<n>``. Spark writes the ``_SUCCESS`` marker as the last
step of a write, so a version without one was interrupted and is never read: a failed load
leaves the previous version in place, and a table can be rewritten while it is being read.

Tables that only grow (facts, run log) are folders of parts; every committed part counts.
Writing a part again under the same name replaces it, which makes a repeated batch harmless.

Where several writers may go on from one version, ``publish`` writes the data aside first and makes it the
next version by a claim: a small file ``claims/<n>`` that names the data's folder and its owner and is created
only if absent. Of two writers one gets the number; the other starts again from what the first has written. A
writer that dies before its claim leaves nothing but an unused folder.

Tables that are rewritten in part are folders ``bucket=<b>``; ``replace_buckets`` exchanges those it is given
and leaves the files of all others alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from starmill.sources.shared import create_if_absent, delete_path, filesystem, read_text

# Folders of parts and buckets; no table may have a column of these names.
PART = "stored_part"
BUCKET = "bucket"


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _committed(self, table: str, prefix: str) -> list[str]:
        pattern, fs = filesystem(self.spark, f"{self.root}/{table}/{prefix}=*/_SUCCESS")
        found = fs.globStatus(pattern) or []
        return sorted(status.getPath().getParent().getName().split("=", 1)[1] for status in found)

    def _claims(self, table: str) -> list[int]:
        pattern, fs = filesystem(self.spark, f"{self.root}/{table}/claims/[0-9]*")
        return [int(status.getPath().getName()) for status in fs.globStatus(pattern) or []]

    def _claim(self, table: str, version: int) -> list[str] | None:
        """Folder and owner of a claimed version."""
        text = read_text(self.spark, f"{self.root}/{table}/claims/{version}")
        return None if text is None else text.split("\n", 1)

    def versions(self, table: str) -> list[int]:
        return sorted({*map(int, self._committed(table, "v")), *self._claims(table)})

    def owners(self, table: str) -> list[str]:
        """Who has written the claimed versions that are still kept."""
        found = [self._claim(table, v) for v in self._claims(table)]
        return [claim[1] for claim in found if claim]

    def parts(self, table: str) -> list[str]:
        return self._committed(table, PART)

    def exists(self, table: str) -> bool:
        folder, fs = filesystem(self.spark, f"{self.root}/{table}/buckets")
        return bool(self.versions(table) or self.parts(table) or fs.exists(folder))

    def write(self, table: str, df: DataFrame, version: int | None = None,
              partition_by: Sequence[str] = ()) -> int:
        """Write a new version, which becomes current once it is complete."""
        if version is None:
            version = max(self.versions(table), default=0) + 1
        self._save(df, f"{self.root}/{table}/v={version}", partition_by)
        return version

    def publish(self, table: str, df: DataFrame, base: int, owner: str) -> bool:
        """Make ``df`` the version after ``base``, unless there is one by now; whether that was done."""
        folder = f"data-{uuid.uuid4().hex}"
        self._save(df, f"{self.root}/{table}/{folder}", ())
        if self._commit(table, base + 1, folder, owner):
            return True
        delete_path(self.spark, f"{self.root}/{table}/{folder}")
        return False

    def _commit(self, table: str, version: int, folder: str, owner: str) -> bool:
        note = f"{self.root}/{table}/claims/{version}"
        if version <= max(self.versions(table), default=0) or not create_if_absent(self.spark, note, f"{folder}\n{owner}"):
            return False
        if max(self.versions(table)) > version:  # the number was free again because its version has been pruned
            delete_path(self.spark, note)
            return False
        return True

    def replace_buckets(self, table: str, df: DataFrame) -> None:
        """Exchange the buckets (column ``bucket``) that ``df`` has rows of.

        The rows are kept aside until all are exchanged, so that ``finish_buckets`` can complete a
        write that was cut short. ``df`` may read the table itself.
        """
        aside = f"{self.root}/{table}/replacing"
        df.write.mode("overwrite").parquet(aside)
        self.finish_buckets(table)

    def finish_buckets(self, table: str) -> None:
        """Complete an exchange of buckets that was interrupted, if there is one."""
        aside = f"{self.root}/{table}/replacing"
        done, fs = filesystem(self.spark, f"{aside}/_SUCCESS")
        if not fs.exists(done):
            return
        # One file per bucket; a heavy one is split by the adaptive rebalance.
        (self.spark.read.parquet(aside).hint("rebalance", BUCKET).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(f"{self.root}/{table}/buckets"))
        delete_path(self.spark, aside)

    def read_buckets(self, table: str, schema: StructType, buckets: Sequence[int] | None = None) -> DataFrame:
        """A table of buckets, with its column ``bucket``; with ``buckets`` only those are read."""
        self.finish_buckets(table)
        path = f"{self.root}/{table}/buckets"
        folder, fs = filesystem(self.spark, path)
        whole = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
        if not fs.exists(folder):
            return self.spark.createDataFrame([], whole)
        found = self.spark.read.schema(whole).parquet(path)
        return found if buckets is None else found.where(F.col(BUCKET).isin([int(b) for b in buckets]))

    def append(self, table: str, df: DataFrame, part: str,
               partition_by: Sequence[str] = ()) -> None:
        self._save(df, f"{self.root}/{table}/{PART}={part}", partition_by)

    def _save(self, df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)

    def read(self, table: str, schema: StructType | None = None,
             before: int | None = None, version: int | None = None,
             parts: Sequence[str] | None = None) -> DataFrame:
        """Current version (or the newest older than ``before``), or all parts of a growing table.

        ``version`` or ``parts`` name some. With a ``schema`` a table that does not exist yet reads as empty.
        """
        versions = [v for v in self.versions(table)
                    if (before is None or v < before) and version in (None, v)]
        if versions:
            claim = self._claim(table, versions[-1])
            paths = [f"{self.root}/{table}/" + (claim[0] if claim else f"v={versions[-1]}")]
        else:
            paths = [f"{self.root}/{table}/{PART}={p}" for p in self.parts(table) if parts is None or p in parts]
        if not paths:
            if schema is None:
                raise FileNotFoundError(f"no committed version of {table}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        if versions:  # the path is its own root, so the folder's name is no column
            return reader.parquet(*paths)
        return reader.option("basePath", f"{self.root}/{table}").parquet(*paths).drop(PART)

    def drop_part(self, table: str, part: str) -> None:
        delete_path(self.spark, f"{self.root}/{table}/{PART}={part}")

    def read_part(self, table: str, part: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/{PART}={part}")

    def prune(self, table: str, keep: int = 2, up_to: int | None = None) -> None:
        """Drop all but the newest ``keep`` versions; with ``up_to`` none newer than that."""
        for version in self.versions(table)[:-keep]:
            if up_to is None or version <= up_to:
                claim = self._claim(table, version)
                if claim:
                    delete_path(self.spark, f"{self.root}/{table}/claims/{version}")
                delete_path(self.spark, f"{self.root}/{table}/" + (claim[0] if claim else f"v={version}"))


def bucket_of(columns: Sequence[str], buckets: int) -> Column:
    """The bucket, from 0, of a row's key."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int").alias(BUCKET)
