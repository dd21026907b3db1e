"""Tables as versioned directories, and intermediate results on shared storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A Parquet table; giving the schema saves the footer read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_version(df: DataFrame, root: str, run_id: str) -> str:
    """Write a new state next to the old one and return its path.

    The state just read is never overwritten; the caller switches to the returned
    path once the write has succeeded.  A re-run of the same run replaces its own
    version only.
    """
    path = f"{root}/version={run_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_clustered(df: DataFrame, path: str, by: str, tasks: int, months_of: str | None = None, group_bytes: int = 16 << 20) -> str:
    """Write a table in order of ``by`` within each task, so that row groups have narrow ranges of it, with Bloom filters on it.

    Small row groups are what ranges and single values skip.  ``months_of`` names a date by whose month the table is
    partitioned, as column ``month``.  Rows are dealt by ranges of (month, ``by``), so a heavy value is split over tasks
    by the other columns.
    """
    rest = [c for c in df.columns if c not in (by, months_of)]
    months = [] if months_of is None else ["month"]
    if months:
        df = df.withColumn("month", F.date_trunc("month", months_of).cast("date"))
    salt = F.pmod(F.xxhash64(*rest), F.lit(64)) if rest else F.lit(0)
    rows = df.repartitionByRange(tasks, *months, by, salt).sortWithinPartitions(*months, by)
    options = {"parquet.block.size": str(group_bytes), f"parquet.bloom.filter.enabled#{by}": "true"}
    rows.write.mode("overwrite").options(**options).partitionBy(*months).parquet(path)
    return path


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write a table of the catalog in hash buckets of ``keys``, sorted within them, and read it.

    Tables in equally many buckets of the same keys, such as staged rows, their times and the row log, are joined on
    them without a shuffle.  Rows are brought to their bucket before they are written, so a bucket is one file.
    """
    rows = df.repartition(buckets, *keys)
    rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def append_run(df: DataFrame, path: str, run_id: str) -> None:
    """Add the rows of one run to an accumulating table such as a row log.

    They get a folder of their own, so an interrupted attempt is replaced and not
    doubled.  Reading ``path`` gives all runs, with the run id as column ``run``.
    """
    df.write.mode("overwrite").parquet(f"{path}/run={run_id}")


def refuse_repeat(spark: SparkSession, path: str, run_id: str) -> None:
    """Stop a run that has already logged its rows.

    Its own log would exclude everything and its feed would be replaced by an empty one.
    """
    try:
        spark.read.parquet(f"{path}/run={run_id}")
    except AnalysisException:
        return
    raise ValueError(f"run {run_id} is already in {path}")


def work_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for intermediate results: the session's checkpoint directory.

    Without the setting, ``fallback``, then the context's checkpoint directory, then a folder of the
    warehouse, which is shared wherever tables are; never a folder of one machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or fallback or spark.sparkContext.getCheckpointDir()
    if not path:
        path = f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return path.rstrip("/")


def staged(df: DataFrame, name: str, run_id: str, fallback: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For results that several outputs of a run use.  A lost executor re-reads the
    files instead of recomputing the lineage.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark, fallback)}/{run_id}/{name}"
    df.write.mode("overwrite").parquet(path)
    return read_table(spark, path, df.schema)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with ``*``, on whatever file system it is; empty if there are none."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(f.getPath().toString()) for f in found or [])


class LeftBehind(RuntimeError):
    """Folders that could not be emptied."""


def empty_tables(spark: SparkSession, pattern: str) -> list[str]:
    """Replace every table that matches by one without rows, whatever an interrupted write has left there.

    The columns come from a footer, if there is one; no row is read, and all files below a folder go with the write
    that replaces it.  A folder that cannot be emptied does not keep the others from it; the error comes at the end.
    """
    paths, failed = folders(spark, pattern), {}
    for path in paths:
        try:
            schema = spark.read.parquet(path).schema
        except Exception:  # noqa: BLE001 - no table, or one cut short: it goes all the same
            schema = "emptied string"
        try:
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
        except Exception as error:  # noqa: BLE001 - whatever it is, the other folders come first
            failed[path] = error
    if failed:
        raise LeftBehind(f"not emptied: {', '.join(failed)}") from next(iter(failed.values()))
    return paths


def empty_staged(spark: SparkSession, names: str, run_id: str, fallback: str | None = None) -> list[str]:
    """Empty the intermediate tables of a finished run whose names begin with ``names``."""
    return empty_tables(spark, f"{work_dir(spark, fallback)}/{run_id}/{names}*")
