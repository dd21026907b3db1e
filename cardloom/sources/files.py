"""Feeds out as files of bounded size, partner files in."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardloom.sources.tables import folders, staged

# NULL, the empty text and blanks stay apart, quotes are doubled, and a line is a row.
LOSSLESS_CSV = {
    "nullValue": "\\N",
    "emptyValue": "",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# In this order on the way out, backwards on the way in: each backslash is followed by a letter.
ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))


def free_column(taken: list[str], name: str) -> str:
    """A column name that is not taken."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def _texts(df: DataFrame, change) -> DataFrame:
    """``df`` with a change to its text columns."""
    return df.select(*[change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else f.name for f in df.schema])


def escaped(text: Column) -> Column:
    """Text on one line."""
    for plain, sign in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(sign))
    return text


def unescaped(text: Column) -> Column:
    for plain, sign in reversed(ESCAPES):
        text = F.replace(text, F.lit(sign), F.lit(plain))
    return text


def export_feed(
    df: DataFrame,
    path: str,
    load_day: date,
    rows_per_file: int = 2_000_000,
    file_format: str = "parquet",
    **options: str,
) -> str:
    """Write a feed for one load date as files of at most ``rows_per_file`` rows.

    The partitions are written in parallel and split where they are too long, so no
    shuffle is needed.  Each date has its own folder and a re-run replaces it.  As CSV, NULL is
    ``\\N`` and line breaks and backslashes in text are escaped, so the files can be split
    and :func:`import_files` with ``exported=True`` reads the same rows.
    """
    target = f"{path}/LoadDate={load_day.isoformat()}"
    if file_format == "csv":
        df, options = _texts(df, escaped), {**LOSSLESS_CSV, "emptyValue": '""', **options}
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    writer.format(file_format).options(**options).save(target)
    return target


def numbered(df: DataFrame, out: str) -> DataFrame:
    """Rows of a table of files with numbers 0, 1, 2, ... without gaps: by file name and place in the file.

    The numbers do not depend on how files are split into tasks, so a repeated task gives the same ones.  Files are
    counted first; what is numbered in one task is the list of files.
    """
    file, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    counts = df.groupBy(file.alias("_file")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    placed = df.withColumns({"_file": file, "_place": place}).join(starts, "_file")
    return placed.select(*df.columns, (F.col("_start") + F.col("_place")).alias(out))


MANIFEST = "_manifest"
MANIFEST_SCHEMA = "file_id int, name string, rows long, checksum decimal(38,0)"


class IncompleteExport(RuntimeError):
    """An export without a manifest, or with files other than its manifest says."""


def row_checksum_of(columns: list[str]) -> Column:
    """Sum of row hashes, with NULLs told apart: the same in any order of rows."""
    return F.coalesce(F.sum(F.xxhash64(*columns, *[F.col(c).isNull() for c in columns]).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")


def files_written(df: DataFrame) -> DataFrame:
    """(file_id, name, rows, checksum) of exported files, read back; the id is in the name that Spark gives."""
    name = F.col("_metadata.file_name")
    columns = df.columns
    found = df.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("rows"), row_checksum_of(columns).alias("checksum"))
    number = F.regexp_extract("name", r"part-(\d+)", 1).cast("int")
    return found.select(number.alias("file_id"), "name", "rows", "checksum")


def export_exact(
    df: DataFrame,
    path: str,
    load_day: date,
    rows_per_file: int = 2_000_000,
    file_format: str = "parquet",
    run_id: str | None = None,
    work: str | None = None,
    **options: str,
) -> str:
    """Write a feed as exactly as many files as ``rows_per_file`` asks for, each but the last one full.

    Rows are staged, numbered without gaps, and each goes to the file of its number by one shuffle.  The files are
    read back and compared, by rows and checksum, with what was to be written; then a manifest is written last, so an
    export without one is not complete (:func:`exported_files`).  An empty feed has no files.
    """
    spark = df.sparkSession
    target = f"{path}/LoadDate={load_day.isoformat()}"
    if file_format == "csv":
        df, options = _texts(df, escaped), {**LOSSLESS_CSV, "emptyValue": '""', **options}
    name, columns = free_column(df.columns, "_number"), df.columns
    source = numbered(staged(df, "export", run_id or f"export-{uuid.uuid4().hex}", work), name)
    file_id = F.floor(F.col(name) / rows_per_file).cast("int")
    wanted = source.groupBy(file_id.alias("file_id")).agg(F.count(F.lit(1)).alias("rows"), row_checksum_of(columns).alias("checksum"))
    wanted = {r["file_id"]: (r["rows"], r["checksum"]) for r in wanted.collect()}
    dealt = source.repartitionById(max(1, len(wanted)), file_id).sortWithinPartitions(name).drop(name)
    writer = dealt.write.mode("overwrite").option("maxRecordsPerFile", 0).format(file_format).options(**options)
    if not wanted:
        writer = df.limit(0).coalesce(1).write.mode("overwrite").format(file_format).options(**options)
    writer.save(target)
    back = files_written(spark.read.format(file_format).schema(df.schema).options(**options).load(target)).where("rows > 0")
    manifest = sorted(tuple(r) for r in back.collect())
    if {r[0]: (r[2], r[3]) for r in manifest} != wanted or len(manifest) != len(wanted):
        raise IncompleteExport(f"{target} does not hold what was exported")
    spark.createDataFrame(manifest, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{target}/{MANIFEST}")
    return target


def exported_files(spark: SparkSession, target: str) -> DataFrame:
    """The manifest of a complete export: (file_id, name, rows, checksum)."""
    if not folders(spark, f"{target}/{MANIFEST}/_SUCCESS"):
        raise IncompleteExport(f"{target} has no manifest")
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{target}/{MANIFEST}")


def import_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    file_format: str = "csv",
    exported: bool = False,
    **options: str,
) -> DataFrame:
    """Partner files with a stated schema; nothing is inferred from the data.

    A value of the wrong type, or a row with more or fewer fields, fails the read; another ``mode``
    must be asked for.  ``exported`` is for files of :func:`export_feed`.
    """
    if file_format in ("csv", "json"):
        options = {"mode": "FAILFAST", **options}
    if not exported or file_format != "csv":
        return spark.read.format(file_format).schema(schema).options(**options).load(path)
    rows = spark.read.format("csv").schema(schema).options(**{**LOSSLESS_CSV, **options}).load(path)
    return _texts(rows, unescaped)


class TooManyRejects(RuntimeError):
    """A partner's files have more bad rows than the run allows."""


@dataclass(frozen=True)
class Split:
    """``good`` rows with the stated schema, and ``rejects`` (file, record, reason, line)."""

    good: DataFrame
    rejects: DataFrame


def import_split(
    spark: SparkSession,
    path: str,
    schema: StructType,
    run_id: str,
    most_bad: float = 0.01,
    work: str | None = None,
    **options: str,
) -> Split:
    """Partner files in CSV, read once, with the rows that do not fit the schema put aside.

    ``record`` counts the records of a file from 1, without a header and empty lines; ``reason`` is "fields" for a wrong number
    of them, else the columns whose text is no value of their type.  More than ``most_bad`` of all rows
    bad is an error, after the rejects have been written.
    """
    bad, names = free_column(schema.names, "_bad"), schema.names
    read = StructType([*schema.fields, StructField(bad, StringType())])
    options = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    rows = spark.read.format("csv").schema(read).options(**options).load(path)
    rows = staged(
        rows.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_order"),
        ),
        "import",
        run_id,
        work,
    )
    blocks = rows.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_order").alias("_first"))
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_file", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    texts = StructType([*[StructField(f"c{i}", StringType()) for i in range(len(names))], StructField(bad, StringType())])
    parsed = F.from_csv(F.col(bad), texts.simpleString()[len("struct<") : -1].replace(":", " "), options)
    wrong = [
        F.when(F.col(f"_p.c{i}").isNotNull() & F.col(f"_p.c{i}").try_cast(f.dataType).isNull(), f.name) for i, f in enumerate(schema.fields)
    ]
    reason = F.when(F.col(f"_p.{bad}").isNotNull(), "fields").otherwise(F.concat_ws(",", *wrong))
    rejects = rows.where(F.col(bad).isNotNull()).join(blocks, ["_file", "_start"]).withColumn("_p", parsed)
    rejects = staged(
        rejects.select(
            F.col("_file").alias("file"),
            (F.col("_before") + F.col("_order") - F.col("_first") + 1).alias("record"),
            F.when(reason == "", "format").otherwise(reason).alias("reason"),
            F.col(bad).alias("line"),
        ),
        "rejects",
        run_id,
        work,
    )
    total, found = rows.count(), rejects.count()
    if found > most_bad * total:
        raise TooManyRejects(f"{found} of {total} rows of {path} are bad, see {rejects.inputFiles()[0].rsplit('/', 1)[0]}")
    return Split(rows.where(F.col(bad).isNull()).select(*names), rejects)


def read_run_output(spark: SparkSession, path: str, run_id: int) -> DataFrame:
    """Console output of a run, saved as text, as log lines ``(RunID, LogID, Msg)``.

    LogID rises with the line: the bytes of the files before, in order of their names, the
    start of the file block and the place in the
    block.  A line takes at least one byte, so blocks cannot overlap, and no task
    sees more than one block of a file.  An empty line becomes a NULL message.
    """
    lines = spark.read.text(path).select(
        F.col("value"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_size").alias("_size"),
        F.monotonically_increasing_id().alias("_order"),
    )
    place = F.row_number().over(Window.partitionBy("_file", "_start").orderBy("_order"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = lines.groupBy("_file").agg(F.max("_size").alias("_size"))
    files = files.select("_file", F.coalesce(F.sum(F.col("_size") + 1).over(before), F.lit(0)).alias("_before"))
    return lines.withColumn("_place", place).join(files, "_file").select(
        F.lit(run_id).alias("RunID"),
        (F.col("_before") + F.col("_start") + F.col("_place")).alias("LogID"),
        F.when(F.col("value") != "", F.col("value")).alias("Msg"),
    )
