"""Queries over run logs and over exported and imported files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cardloom.operators import run_log as log
from cardloom.sources.files import export_feed, import_files
from cardloom.sources.tables import work_dir
from workload.registry import query
from workload.roles import AS_OF, Roles

FLAGGED = """
    SELECT l.*, bool_or(COALESCE(Msg ILIKE '%traceback%' OR regexp_matches(Msg, '(?i)error[^a-z]'), FALSE))
           OVER (PARTITION BY RunID) AS isError FROM {run_lines} l"""
EXPECTED = ("view done", "purchase done")


@query(
    "export_import_j1_j2",
    "SELECT FileID, RowNum, CINID, Amount, TranDate FROM {card_tx}",
)
def _(r: Roles):
    spark = r.spark
    root = work_dir(spark)
    feed = r.card_tx.select("FileID", "RowNum", "CINID", "Amount", "TranDate")
    target = export_feed(feed, f"{root}/card-export-{uuid.uuid4().hex}", AS_OF.date(), rows_per_file=5000, file_format="csv", header="true")
    return import_files(spark, target, feed.schema, file_format="csv", exported=True, header="true")


@query(
    "export_import_text_j1_j2",
    """SELECT doc_id, text, '' AS empty, '  ' || left(text, 20) || ' ' AS padded, '"' || lang || '",\\N' AS quoted,
              CASE WHEN lang = 'en' THEN NULL ELSE source || chr(10) || '\\n' || chr(13) END AS broken FROM {documents}""",
)
def _(r: Roles):
    text = r.documents.select(
        "doc_id",
        "text",
        F.lit("").alias("empty"),
        F.concat(F.lit("  "), F.left("text", F.lit(20)), F.lit(" ")).alias("padded"),
        F.concat(F.lit('"'), "lang", F.lit('",\\N')).alias("quoted"),
        F.when(F.col("lang") != "en", F.concat("source", F.lit("\n\\n\r"))).alias("broken"),
    )
    target = export_feed(text, f"{work_dir(r.spark)}/text-export-{uuid.uuid4().hex}", AS_OF.date(), rows_per_file=300, file_format="csv")
    return import_files(r.spark, target, text.schema, file_format="csv", exported=True)


@query("flag_error_runs_j3", FLAGGED)
def _(r: Roles):
    return log.flag_error_runs(r.run_lines)


@query(
    "error_summary_j4",
    "WITH flagged AS ("
    + FLAGGED
    + """), joined AS (SELECT RunID, string_agg(Msg, ' ' ORDER BY LogID) AS text, ' ... run ' || RunID AS pointer
              FROM flagged WHERE isError GROUP BY RunID)
         SELECT RunID, right(text, 60 - length(pointer)) || pointer AS Summary FROM joined WHERE text IS NOT NULL""",
)
def _(r: Roles):
    return log.error_summary(log.flag_error_runs(r.run_lines), pointer=" ... run {run}", max_len=60, block=1000)


@query(
    "residual_lines_j5",
    """SELECT DATE '2001-08-02' AS TranDate, Msg AS line FROM {run_lines}
       WHERE Msg IS NOT NULL AND Msg <> 'view done' AND Msg <> 'purchase done'""",
)
def _(r: Roles):
    return log.residual_lines(r.run_lines, EXPECTED, AS_OF)


@query(
    "append_run_log_j6",
    "WITH flagged AS ("
    + FLAGGED
    + """) SELECT RunID - 1 AS RunID, LogID, Msg, TIMESTAMP '2001-08-01 00:00:00' AS CreatedDateTime, FALSE AS isError FROM {run_lines}
         UNION ALL SELECT RunID, LogID, Msg, TIMESTAMP '2001-08-02 03:00:00', isError FROM flagged""",
)
def _(r: Roles):
    earlier = r.run_lines.select(
        (F.col("RunID") - 1).alias("RunID"),
        "LogID",
        "Msg",
        F.lit("2001-08-01").cast("timestamp_ntz").alias("CreatedDateTime"),
        F.lit(False).alias("isError"),
    )
    return log.append_run_log(earlier, log.flag_error_runs(r.run_lines), AS_OF)
