"""Queries over incremental loading and the card feeds."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from cardloom.config import RunContext
from cardloom.functions.compat import half_hour, time_text
from cardloom.functions.joins import union_all
from cardloom.functions.keys import tran_sequence_id
from cardloom.operators import card, incremental as inc, row_runs
from cardloom.plans import card as plan
from cardloom.sources.tables import staged, work_dir, write_bucketed, write_clustered
from workload.registry import query
from workload.roles import AS_OF, Roles

RUN = RunContext("check", AS_OF)
SATURDAY = datetime(2001, 8, 4, 3, 0, 0)
KEYS = list(inc.ROW_KEY)

ELIGIBLE = """
    SELECT cinid FROM {programme} c WHERE inprogram = 1 AND NOT EXISTS (SELECT 1 FROM {archive} a WHERE a.cinid = c.cinid)
    UNION SELECT cinid FROM {programme} WHERE RegistrationDate > DATE '2001-07-02'"""
HISTORY = """
    SELECT h.* FROM (SELECT *, 1 AS PaymentTypeID FROM {debit_history}
                     UNION ALL SELECT *, NULL AS InputModeID, 2 AS PaymentTypeID FROM {credit_history}) h
    WHERE TranDate > DATE '1996-08-01' AND CINID IN (SELECT cinid FROM eligible)
      AND NOT EXISTS (SELECT 1 FROM {row_log} l WHERE l.FileID = h.FileID AND l.RowNum = h.RowNum)"""
ROUNDED = """CASE WHEN TranTime IS NULL THEN NULL WHEN substr(TranTime, 4, 2) >= '30'
             THEN substr(TranTime, 1, 2) || ':30:00' ELSE substr(TranTime, 1, 2) || ':00:00' END"""
STAGED = """
    SELECT *, 1 AS PaymentTypeID FROM {debit_holding} UNION ALL SELECT *, 2 AS PaymentTypeID FROM {credit_holding}"""


def tables(r: Roles) -> plan.CardTables:
    return plan.CardTables(
        debit_holding=r.debit_holding,
        credit_holding=r.credit_holding,
        debit_history=r.debit_history,
        credit_history=r.credit_history,
        times=r.tran_time,
        customers=r.programme,
        archive=r.archive,
        merchants=r.merchants,
        periods=r.periods,
        mcc=r.mcc,
        row_log=r.row_log,
        detailed_row_log=r.row_log_detailed,
        extra_backfill=r.extra_backfill,
    )


@query(
    "incremental_append_a1",
    """SELECT h.*, 1 AS PaymentTypeID FROM {debit_holding} h LEFT JOIN (SELECT DISTINCT FileID, RowNum, 1 AS seen FROM {staged_before}) s
       USING (FileID, RowNum) WHERE seen IS NULL""",
)
def _(r: Roles):
    return inc.incremental_append(r.debit_holding, r.staged_before, consts={"PaymentTypeID": 1})


@query(
    "exclude_logged_a2",
    """SELECT FileID, RowNum, CINID, Amount FROM {card_tx} t
       WHERE NOT EXISTS (SELECT 1 FROM {row_log} l WHERE l.FileID = t.FileID AND l.RowNum = t.RowNum)
         AND NOT EXISTS (SELECT 1 FROM {row_log_detailed} l WHERE l.FileID = t.FileID AND l.RowNum = t.RowNum)""",
)
def _(r: Roles):
    tx = r.card_tx.select(*KEYS, "CINID", "Amount")
    return inc.exclude_logged(tx, r.row_log, r.row_log_detailed, prune_by="FileID")


@query(
    "exclude_logged_bucketed_a2",
    """SELECT t.FileID, t.RowNum, CINID, Amount, TranTime FROM {card_tx} t LEFT JOIN {tran_time} n ON n.FileID = t.FileID AND n.RowNum = t.RowNum
       WHERE NOT EXISTS (SELECT 1 FROM {row_log} l WHERE l.FileID = t.FileID AND l.RowNum = t.RowNum)
         AND NOT EXISTS (SELECT 1 FROM {row_log_detailed} l WHERE l.FileID = t.FileID AND l.RowNum = t.RowNum)""",
)
def _(r: Roles):
    """Rows, both logs and the times in the same buckets of the row key."""
    root, name = work_dir(r.spark), uuid.uuid4().hex
    tables = {"tx": r.card_tx.select(*KEYS, "CINID", "Amount"), "log": r.row_log, "detailed": r.row_log_detailed, "times": r.tran_time}
    held = {k: write_bucketed(df, f"{k}_{name}", f"{root}/{k}-{name}", KEYS, 8) for k, df in tables.items()}
    fresh = inc.exclude_logged(held["tx"], held["log"], held["detailed"], colocated=True)
    return card.attach_time(fresh, held["times"], round_down=False)


@query(
    "exclude_logged_runs_a2",
    """SELECT FileID, RowNum, CINID, Amount FROM {card_tx} t
       WHERE NOT EXISTS (SELECT 1 FROM {row_log} l WHERE l.FileID = t.FileID AND l.RowNum = t.RowNum)
         AND NOT EXISTS (SELECT 1 FROM {row_log_detailed} l WHERE l.FileID = t.FileID AND l.RowNum = t.RowNum)""",
)
def _(r: Roles):
    tx = r.card_tx.select(*KEYS, "CINID", "Amount")
    return inc.exclude_logged(tx, row_runs.row_runs(r.row_log), row_runs.row_runs(r.row_log_detailed), prune_by="FileID")


@query(
    "append_row_runs_a3",
    """WITH rows AS (SELECT FileID, RowNum FROM {row_log} UNION SELECT FileID, RowNum FROM {debit_holding}
            UNION SELECT FileID, RowNum FROM {credit_holding}),
        numbered AS (SELECT FileID, RowNum, RowNum - row_number() OVER (PARTITION BY FileID ORDER BY RowNum) AS island
            FROM rows WHERE FileID IS NOT NULL AND RowNum IS NOT NULL)
       SELECT FileID, CAST(min(RowNum) AS BIGINT) AS FirstRow, CAST(max(RowNum) AS BIGINT) AS LastRow FROM numbered GROUP BY FileID, island""",
)
def _(r: Roles):
    return row_runs.append_runs(row_runs.row_runs(r.row_log), r.debit_holding, r.credit_holding)


@query(
    "append_row_log_a3",
    """SELECT FileID, RowNum FROM {row_log} UNION ALL
       SELECT FileID, RowNum FROM {debit_holding} UNION ALL SELECT FileID, RowNum FROM {credit_holding}""",
)
def _(r: Roles):
    return inc.append_row_log(r.row_log, r.debit_holding, r.credit_holding)


@query(
    "dated_row_log_a3",
    "SELECT FileID, RowNum, TIMESTAMP '2001-08-02 03:00:00' AS ProcessedDate FROM {dd_tx}",
)
def _(r: Roles):
    return inc.log_rows(r.dd_tx, processed_at=AS_OF)


@query("append_load_date_a4", "SELECT LoadDate FROM {load_dates} UNION ALL SELECT DATE '2001-08-01'")
def _(r: Roles):
    return inc.append_load_date(r.load_dates, AS_OF)


@query(
    "last_load_date_a4",
    "SELECT max(LoadDate) AS LastLoadDate FROM {load_dates} WHERE LoadDate < DATE '2001-08-02'",
)
def _(r: Roles):
    return inc.last_load_date(r.load_dates, AS_OF)


@query("newly_eligible_a5", ELIGIBLE)
def _(r: Roles):
    return inc.newly_eligible(r.programme, r.archive, AS_OF)


@query(
    "eligible_flag_a6",
    "WITH eligible AS (" + ELIGIBLE + ") SELECT p.cinid, CASE WHEN e.cinid IS NULL THEN 0 ELSE 1 END AS prereg_flag"
    " FROM {programme} p LEFT JOIN eligible e ON e.cinid = p.cinid",
)
def _(r: Roles):
    flag = inc.save_eligible_flag(inc.newly_eligible(r.programme, r.archive, AS_OF))
    marked = r.programme.select("cinid").join(flag.withColumn("_f", F.lit(1)), "cinid", "left")
    return marked.select("cinid", F.coalesce("_f", F.lit(0)).alias("prereg_flag"))


@query("history_backfill_a7", "WITH eligible AS (" + ELIGIBLE + ")" + HISTORY)
def _(r: Roles):
    eligible = inc.newly_eligible(r.programme, r.archive, AS_OF)
    return inc.backfill_history(r.debit_history, r.credit_history, eligible, [r.row_log], AS_OF)


@query("history_backfill_pruned_a7", "WITH eligible AS (" + ELIGIBLE + ")" + HISTORY)
def _(r: Roles):
    """The same rows from a history in order of customers, cut to the ranges of the eligible ones."""
    root, name = work_dir(r.spark), uuid.uuid4().hex
    eligible = staged(inc.newly_eligible(r.programme, r.archive, AS_OF), "eligible", f"backfill-{name}")
    kept = {}
    for kind in ("debit_history", "credit_history"):
        path = write_clustered(getattr(r, kind), f"{root}/{kind}-{name}", "CINID", tasks=8, months_of="TranDate")
        kept[kind] = r.spark.read.parquet(path).drop("month")
    found = inc.eligible_history(kept["debit_history"], kept["credit_history"], eligible, AS_OF, prune_ids=True)
    return inc.exclude_logged(found, r.row_log)


@query(
    "extra_backfill_a8",
    "WITH eligible AS (" + ELIGIBLE + "), base AS (" + HISTORY + ")"
    """ SELECT FileID, RowNum, CINID, Amount, PaymentTypeID, InputModeID FROM base UNION ALL
        SELECT FileID, RowNum, CINID, Amount, PaymentTypeID, NULL FROM {extra_backfill} x
        WHERE NOT EXISTS (SELECT 1 FROM {row_log_detailed} l WHERE l.FileID = x.FileID AND l.RowNum = x.RowNum)
          AND NOT EXISTS (SELECT 1 FROM {row_log} l WHERE l.FileID = x.FileID AND l.RowNum = x.RowNum)
          AND NOT EXISTS (SELECT 1 FROM base b WHERE b.FileID = x.FileID AND b.RowNum = x.RowNum)""",
)
def _(r: Roles):
    eligible = inc.newly_eligible(r.programme, r.archive, AS_OF)
    base = inc.backfill_history(r.debit_history, r.credit_history, eligible, [r.row_log], AS_OF)
    both = inc.append_extra_backfill(base, r.extra_backfill, [r.row_log_detailed, r.row_log])
    return both.select(*KEYS, "CINID", "Amount", "PaymentTypeID", "InputModeID")


@query("snapshot_a9", "SELECT cinid FROM {programme} WHERE inprogram = 1")
def _(r: Roles):
    return inc.snapshot_overwrite(r.programme)


@query("purge_a10", "SELECT FileID, RowNum FROM {credit_holding}")
def _(r: Roles):
    kept = inc.purge_on_weekday(r.credit_holding.select(*KEYS), AS_OF)
    emptied = inc.purge_on_weekday(r.debit_holding.select(*KEYS), SATURDAY)
    return union_all(kept, emptied, inc.purge(r.row_log))


@query(
    "attach_time_b1",
    "SELECT d.*, t.TranTime FROM {debit_history} d LEFT JOIN {tran_time} t ON t.FileID = d.FileID AND t.RowNum = d.RowNum",
)
def _(r: Roles):
    return card.attach_time(r.debit_history, r.tran_time, round_down=False)


@query(
    "half_hour_b2",
    """SELECT event_id, strftime(time_bucket(INTERVAL 30 MINUTE, ts), '%H:%M:%S') AS half_hour FROM {events}""",
)
def _(r: Roles):
    return r.events.select("event_id", half_hour(time_text("ts")).alias("half_hour"))


SELECT_NEW = f"""
    SELECT s.*, {ROUNDED} AS TranTime
    FROM staged s LEFT JOIN {{tran_time}} t ON t.FileID = s.FileID AND t.RowNum = s.RowNum
    WHERE NOT EXISTS (SELECT 1 FROM {{row_log}} l WHERE l.FileID = s.FileID AND l.RowNum = s.RowNum)
      AND NOT EXISTS (SELECT 1 FROM history b WHERE b.FileID = s.FileID AND b.RowNum = s.RowNum)"""
FEED_INPUTS = "WITH eligible AS (" + ELIGIBLE + "), history AS (" + HISTORY + "), staged AS (" + STAGED + ")"


@query("select_new_b3", FEED_INPUTS + SELECT_NEW)
def _(r: Roles):
    t = tables(r)
    backfill = plan.backfill_rows(t, RUN, plan.eligible_customers(t, RUN))
    return card.select_new(t.debit_holding, t.credit_holding, t.times, [t.row_log], backfill)


@query(
    "sequence_id_b4",
    "SELECT FileID, RowNum, '1-' || CAST(FileID AS VARCHAR) || '-' || CAST(RowNum AS VARCHAR) AS TranSequenceID FROM {card_tx}",
)
def _(r: Roles):
    return r.card_tx.select(*KEYS, tran_sequence_id(1, "FileID", "RowNum").alias("TranSequenceID"))


def enriched_sql(source: str, condition: str) -> str:
    return f"""
    SELECT t.FileID, t.RowNum, t.ConsumerCombinationID, t.CardholderPresentData, t.CINID, t.Amount, t.IsOnline,
           t.PaymentTypeID, t.TranDate, t.TranTime, t.InputModeID, m.BrandID,
           CASE WHEN s.BrandID IS NULL THEN 0 ELSE 1 END AS subscription_flag, c.MCC AS mcc, m.MID AS mid,
           p.insight_ageband AS currentagebandtext, 1 AS publisherid,
           '1-' || CAST(t.FileID AS VARCHAR) || '-' || CAST(t.RowNum AS VARCHAR) AS TranSequenceID
    FROM {source} t JOIN {{programme}} p ON p.cinid = t.CINID JOIN {{merchants}} m USING (ConsumerCombinationID)
    LEFT JOIN {{mcc}} c ON c.MCCID = m.MCCID
    LEFT JOIN {{periods}} s ON s.BrandID = m.BrandID AND s.Amount = t.Amount AND s.startdate <= t.TranDate
         AND (s.enddate > t.TranDate OR s.enddate IS NULL AND t.TranDate < DATE '2100-01-01')
    WHERE {condition}"""


@query(
    "enrich_card_b5",
    "WITH tx AS (SELECT d.*, 1 AS PaymentTypeID, t.TranTime FROM {debit_holding} d LEFT JOIN {tran_time} t USING (FileID, RowNum))"
    + enriched_sql("tx", "p.inprogram = 1"),
)
def _(r: Roles):
    tx = r.debit_holding.withColumn("PaymentTypeID", F.lit(1))
    timed = card.attach_time(tx, r.tran_time, round_down=False)
    return card.enrich_card(timed, r.programme, r.merchants, r.periods, r.mcc)


@query(
    "enrich_card_salted_b5",
    "WITH tx AS (SELECT h.*, CAST(NULL AS INTEGER) AS InputModeID, 2 AS PaymentTypeID, t.TranTime"
    " FROM {credit_history} h LEFT JOIN {tran_time} t USING (FileID, RowNum))" + enriched_sql("tx", "p.inprogram = 1"),
)
def _(r: Roles):
    tx = r.credit_history.withColumns({"InputModeID": F.lit(None).cast("int"), "PaymentTypeID": F.lit(2)})
    timed = card.attach_time(tx, r.tran_time, round_down=False)
    return card.enrich_card(timed, r.programme, r.merchants, r.periods, r.mcc, rows_per_split=20)


@query(
    "subscription_flag_b6",
    """SELECT t.FileID, t.RowNum, m.BrandID, t.Amount, t.TranDate, CASE WHEN s.BrandID IS NULL THEN 0 ELSE 1 END AS subscription_flag
       FROM {card_tx} t JOIN {merchants} m USING (ConsumerCombinationID)
       LEFT JOIN {periods} s ON s.BrandID = m.BrandID AND s.Amount = t.Amount AND t.TranDate >= s.startdate
            AND t.TranDate < COALESCE(s.enddate, DATE '2100-01-01')""",
)
def _(r: Roles):
    branded = r.card_tx.join(r.merchants.select("ConsumerCombinationID", "BrandID"), "ConsumerCombinationID")
    return card.subscription_flag(branded.select(*KEYS, "BrandID", "Amount", "TranDate"), r.periods)


@query(
    "subscription_flag_binned_b6",
    """WITH more AS (SELECT BrandID, Amount, startdate, enddate FROM {periods} UNION ALL
           SELECT BrandID, Amount, startdate + CAST(20 * i AS INTEGER), startdate + CAST(20 * i + 30 AS INTEGER) FROM {periods}, range(60) r(i))
       SELECT t.FileID, t.RowNum, m.BrandID, t.Amount, t.TranDate, CASE WHEN s.BrandID IS NULL THEN 0 ELSE 1 END AS subscription_flag
       FROM {card_tx} t JOIN {merchants} m USING (ConsumerCombinationID)
       LEFT JOIN more s ON s.BrandID = m.BrandID AND s.Amount = t.Amount AND t.TranDate >= s.startdate
            AND t.TranDate < COALESCE(s.enddate, DATE '2100-01-01')""",
)
def _(r: Roles):
    """Sixty overlapping periods of a month more for each price."""
    shift = F.explode(F.sequence(F.lit(0), F.lit(59))).alias("i")
    more = r.periods.select("BrandID", "Amount", "startdate", shift).select(
        "BrandID", "Amount", F.expr("date_add(startdate, 20 * i)").alias("startdate"), F.expr("date_add(startdate, 20 * i + 30)").alias("enddate")
    )
    periods = r.periods.select("BrandID", "Amount", "startdate", "enddate").unionByName(more)
    branded = r.card_tx.join(r.merchants.select("ConsumerCombinationID", "BrandID"), "ConsumerCombinationID")
    return card.subscription_flag(branded.select(*KEYS, "BrandID", "Amount", "TranDate"), periods, period_bin="month")


FEED = """
    SELECT TranSequenceID, ConsumerCombinationID, CardholderPresentData, CINID, Amount, IsOnline, PaymentTypeID, TranDate,
           BrandID, subscription_flag, publisherid, mcc, {mid} AS mid, currentagebandtext, TranTime, {more}
           'N' AS UpdateType, DATE '2001-08-01' AS UpdateDate, DATE '2001-08-01' AS LoadDate FROM enriched"""


@query(
    "card_feed_b7",
    FEED_INPUTS
    + ", fresh AS ("
    + SELECT_NEW
    + f"), timed AS (SELECT h.*, {ROUNDED} AS TranTime FROM history h LEFT JOIN {{tran_time}} t USING (FileID, RowNum))"
    + ", tx AS (SELECT * FROM fresh UNION ALL BY NAME SELECT * FROM timed), enriched AS ("
    + enriched_sql("tx", "p.inprogram = 1")
    + ")"
    + FEED.replace("{mid}", "replace(mid, ',', '')").replace("{more}", ""),
)
def _(r: Roles):
    t = tables(r)
    backfill = plan.backfill_rows(t, RUN, plan.eligible_customers(t, RUN))
    return card.card_feed(plan.standard_rows(t, backfill), AS_OF)


@query(
    "card_feed_detailed_b7",
    FEED_INPUTS
    + """, fresh AS (SELECT s.*, t.TranTime, FALSE AS IsBackfill FROM staged s LEFT JOIN {tran_time} t USING (FileID, RowNum)
            WHERE NOT EXISTS (SELECT 1 FROM {row_log_detailed} l WHERE l.FileID = s.FileID AND l.RowNum = s.RowNum)),
        timed AS (SELECT h.*, t.TranTime, TRUE AS IsBackfill FROM history h LEFT JOIN {tran_time} t USING (FileID, RowNum)),
        extra AS (SELECT x.*, TRUE AS IsBackfill FROM {extra_backfill} x
            WHERE NOT EXISTS (SELECT 1 FROM {row_log_detailed} l WHERE l.FileID = x.FileID AND l.RowNum = x.RowNum)
              AND NOT EXISTS (SELECT 1 FROM {row_log} l WHERE l.FileID = x.FileID AND l.RowNum = x.RowNum)
              AND NOT EXISTS (SELECT 1 FROM history b WHERE b.FileID = x.FileID AND b.RowNum = x.RowNum)),
        tx AS (SELECT * FROM fresh UNION ALL BY NAME SELECT * FROM timed UNION ALL BY NAME SELECT * FROM extra), enriched AS ("""
    + enriched_sql("tx", "p.inprogram = 1 OR NOT t.IsBackfill")
    + ")"
    + FEED.replace("{mid}", "mid").replace("{more}", "FileID, RowNum, InputModeID,"),
)
def _(r: Roles):
    t = tables(r)
    backfill = plan.backfill_rows(t, RUN, plan.eligible_customers(t, RUN))
    return card.card_feed(plan.detailed_rows(t, backfill), AS_OF, detailed=True)
