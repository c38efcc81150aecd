"""Tables of the session catalog that lie bucketed by a common key, so that joins on it move no rows."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: File bytes of a bucket that ``buckets_for`` aims at. One task sorts a bucket, decoded some ten times as large.
BUCKET_BYTES = 32 << 20


def buckets_for(total_bytes: float, least: int = 8) -> int:
    """A power of two of buckets for the largest table of a group, so that groups of other sizes still match."""
    return 1 << max(0, math.ceil(math.log2(max(least, total_bytes / BUCKET_BYTES))))


class ColocatedTables:
    """A group of tables, each hashed by ``key`` into the same number of buckets.

    A bucket is one file, written by the task that its keys are shuffled to; every publish pays this
    shuffle once, and each join of tables of the group on the key is spared it. A publish writes
    a new table and then moves the view that readers use, so readers see the former rows or the new ones. Given a
    ``location``, files lie there, otherwise in the warehouse.
    """

    def __init__(self, spark: SparkSession, group: str, key: str, buckets: int, location: str | None = None) -> None:
        self.spark, self.group, self.key, self.buckets, self.location = spark, group, key, buckets, location

    def _view(self, name: str) -> str:
        return f"{self.group}_{name}"

    def publish(self, name: str, df: DataFrame) -> None:
        table = f"{self._view(name)}_{uuid.uuid4().hex}"
        writer = (
            df.repartition(self.buckets, F.col(self.key))
            .sortWithinPartitions(self.key)
            .write.format("parquet")
            .bucketBy(self.buckets, self.key)
            .sortBy(self.key)
        )
        if self.location:
            writer = writer.option("path", f"{self.location.rstrip('/')}/{table}")
        writer.saveAsTable(table)
        self.spark.sql(f"CREATE OR REPLACE VIEW `{self._view(name)}` AS SELECT * FROM `{table}`")

    def read(self, name: str) -> DataFrame:
        return self.spark.table(f"`{self._view(name)}`")

    def versions(self, name: str) -> list[str]:
        """Tables that publishes of ``name`` have made and that still exist."""
        prefix = f"{self._view(name)}_"
        found = (table.name for table in self.spark.catalog.listTables() if table.tableType != "VIEW")
        return sorted(table for table in found if table.startswith(prefix) and len(table) == len(prefix) + 32)

    def expire(self, name: str) -> None:
        """Drop the tables of ``name`` that the view no longer reads. Files at a given location stay."""
        text = self.spark.sql(f"SHOW CREATE TABLE `{self._view(name)}`").first()[0]
        for table in self.versions(name):
            if table not in text:
                self.spark.sql(f"DROP TABLE `{table}`")
