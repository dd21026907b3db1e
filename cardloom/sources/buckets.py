"""State kept in hash buckets of its key, of which an update rewrites only those with a change.

A bucket is a folder of Parquet files that is never changed.  A version is a manifest that names one folder for each
bucket, old or new, and it is written last: readers resolve through it, so an update that fails leaves the state
as it was, and two versions share the buckets that are equal.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardloom.functions.joins import anti, semi
from cardloom.sources.publish import publish, published, refuse_published
from cardloom.sources.tables import folders

BUCKET = "_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """A row's bucket; NULL keys have one like any other."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class BucketedState:
    """A table under ``root`` in ``buckets`` buckets of ``keys``.

    The schema is stated once; rows keep to it.  A heavy key makes one folder large but not one
    task: a bucket is written in as many files as ``files_per_bucket`` says.
    """

    spark: SparkSession
    root: str
    schema: StructType
    keys: tuple[str, ...]
    buckets: int = 256
    files_per_bucket: int = 1

    @property
    def manifests(self) -> str:
        return f"{self.root}/versions"

    def manifest(self, version: str | None = None) -> dict[int, str]:
        """The folder of every bucket that has rows, by default in the last version."""
        return {int(b): paths[0] for b, paths in published(self.spark, self.manifests, version).items()}

    def read(self, version: str | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The table, or the buckets in ``only``; others are not listed."""
        held = self.manifest(version)
        paths = [f"{self.root}/{held[b]}" for b in sorted(held) if only is None or b in set(only)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def buckets_of(self, changed: DataFrame) -> list[int]:
        """Buckets of the keys in ``changed``: at most ``buckets`` numbers reach the driver."""
        found = changed.select(bucket_of(self.keys, self.buckets).alias("b")).distinct().collect()
        return sorted(r["b"] for r in found)

    def write(self, df: DataFrame, version: str) -> dict[int, str]:
        """A whole new state."""
        return self.replace(df, version, list(range(self.buckets)))

    def replace(self, df: DataFrame, version: str, numbers: Sequence[int]) -> dict[int, str]:
        """Buckets ``numbers`` replaced by the rows of ``df``, which must belong there; the other buckets stay.

        A repeated version replaces its own files before its manifest names them again.
        """
        refuse_published(self.spark, self.manifests, version)
        before, folder = self.manifest(), f"data/run={version}"
        rows = df.select(*self.schema.names).withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        salt = F.pmod(F.xxhash64(*self.schema.names), F.lit(self.files_per_bucket))
        tasks = max(1, min(len(numbers), self.buckets) * self.files_per_bucket)
        rows = rows.repartition(tasks, F.col(BUCKET), salt)
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        written = folders(self.spark, f"{self.root}/{folder}/{BUCKET}=*")
        new = {int(p.rsplit("=", 1)[1]): f"{folder}/{p.rsplit('/', 1)[1]}" for p in written}
        if not set(new) <= set(numbers):
            raise ValueError(f"rows of buckets that are not replaced: {sorted(set(new) - set(numbers))[:5]}")
        after = {b: p for b, p in before.items() if b not in set(numbers)} | new
        publish(self.spark, self.manifests, version, {str(b): p for b, p in sorted(after.items())})
        return after

    def update(self, changed: DataFrame, version: str, renew: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """A new version in which only buckets with a key of ``changed`` are rewritten; their numbers.

        ``renew(old, changed)`` gives the new rows of these buckets from their old ones.
        """
        numbers = self.buckets_of(changed)
        self.replace(renew(self.read(only=numbers), changed), version, numbers)
        return numbers

    def upsert(self, rows: DataFrame, version: str) -> list[int]:
        """Keys of ``rows`` replaced by them, all rows of a key together; other keys stay."""
        names = self.schema.names
        return self.update(rows, version, lambda old, new: anti(old, new, self.keys).select(*names).unionByName(new.select(*names)))

    def delete(self, keys: DataFrame, version: str) -> list[int]:
        """All rows with a key in ``keys`` removed; a NULL key matches nothing."""
        return self.update(keys, version, lambda old, gone: anti(old, gone, self.keys))

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys, from their buckets alone."""
        return semi(self.read(only=self.buckets_of(keys)), keys, self.keys)
