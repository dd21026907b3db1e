"""Whole runs on disk: outputs, logs, idempotence and file splitting."""

from __future__ import annotations

import dataclasses
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cardloom.config import RunContext
from cardloom.functions.joins import in_ranges, key_ranges, within
from cardloom.operators import direct_debit as dd, incremental as inc
from cardloom.operators.card import attach_time
from cardloom.operators.incremental import exclude_logged
from cardloom.operators.row_runs import expanded, row_runs
from cardloom.operators.run_log import flag_error_runs
from cardloom.plans import card as card_plan
from cardloom.plans import dimensions as dims
from cardloom.plans import direct_debit as dd_plan
from cardloom.plans import quarantine as q_plan
from cardloom.plans import run_log as log_plan
from cardloom.sources.files import TooManyRejects, export_feed, exported_files, import_files, import_split, read_run_output
from cardloom.sources.publish import published
from cardloom.sources.tables import folders, read_table, staged, work_dir, write_bucketed, write_clustered, write_version
from tests.conftest import rows
from workload import addresses, customers, direct_debit
from workload.card import tables as card_tables
from workload.roles import AS_OF, EVENTS_FROM, Roles

SF = "/root/testdata/sf0.001"


@pytest.fixture
def r(spark):
    return Roles(spark, SF)


def test_export_splits_and_import_reads(spark, tmp_path):
    df = spark.range(10).coalesce(1).withColumn("d", F.lit(date(2024, 1, 1)))
    target = export_feed(df, str(tmp_path / "feed"), date(2024, 1, 2), rows_per_file=3, file_format="csv", header="true")
    assert target.endswith("LoadDate=2024-01-02") and len(list(Path(target).glob("part-*"))) == 4
    assert rows(import_files(spark, target, df.schema, header="true")) == rows(df)


def test_versions_and_staging(spark, tmp_path):
    root = str(tmp_path / "t")
    first = write_version(spark.range(3), root, "1")
    second = write_version(read_table(spark, first).union(spark.range(1)), root, "2")
    assert read_table(spark, first).count() == 3 and read_table(spark, second).count() == 4
    kept = staged(spark.range(5), "five", "run")
    assert kept.count() == 5 and work_dir(spark) in kept.inputFiles()[0]


def test_card_feed_run_is_idempotent(spark, r, tmp_path):
    out, t = str(tmp_path), card_tables(r)
    first = card_plan.run_card_feed(spark, t, RunContext("one", AS_OF), out, rows_per_file=500)
    feed = read_table(spark, first["feed"])
    pure = card_plan.standard_rows(t, card_plan.backfill_rows(t, RunContext("x", AS_OF), card_plan.eligible_customers(t, RunContext("x", AS_OF))))
    assert feed.count() == pure.count() > 0
    key = ["FileID", "RowNum", "TranTime", "mid", "subscription_flag"]
    named = F.concat_ws("-", F.lit("1"), "FileID", "RowNum").alias("TranSequenceID")
    assert rows(feed.select("TranSequenceID", "TranTime")) == rows(pure.select(named, *key[2:3]))
    assert not [p for p in folders(spark, f"{work_dir(spark)}/one/standard-*") if spark.read.parquet(p).count()]
    log = read_table(spark, f"{out}/standard_row_log")
    assert log.count() == feed.count() and set(first) == {"feed", "archive"}
    grown = dataclasses.replace(t, row_log=t.row_log.union(log.select("FileID", "RowNum")))
    again = card_plan.run_card_feed(spark, grown, RunContext("two", datetime(2001, 8, 3, 3)), out)
    assert read_table(spark, again["feed"]).count() == 0
    assert read_table(spark, f"{out}/load_dates").count() == 2
    with pytest.raises(ValueError, match="already"):
        card_plan.run_card_feed(spark, t, RunContext("one", AS_OF), out)
    assert read_table(spark, first["feed"]).count() == feed.count()


def test_detailed_run_and_saturday_purge(spark, r, tmp_path):
    out, t = str(tmp_path), card_tables(r)
    paths = card_plan.run_card_feed(spark, t, RunContext("one", AS_OF), out, detailed=True)
    assert read_table(spark, paths["feed"]).count() == read_table(spark, f"{out}/detailed_row_log").count() > 0
    saturday = card_plan.run_card_feed(spark, t, RunContext("sat", datetime(2001, 8, 4, 9)), out)
    assert read_table(spark, saturday["debit_holding"]).count() == 0
    assert read_table(spark, saturday["credit_holding"]).columns == t.credit_holding.columns


def test_repartitioned_input_gives_the_same_feed(spark, r):
    t = card_tables(r)
    run = RunContext("x", AS_OF)
    mixed = dataclasses.replace(t, debit_history=t.debit_history.repartition(7), row_log=t.row_log.repartition(3), merchants=t.merchants.repartition(5))
    make = lambda x: card_plan.standard_rows(x, card_plan.backfill_rows(x, run, card_plan.eligible_customers(x, run)))
    assert rows(make(mixed)) == rows(make(t))


def test_quarantine_run(spark, r, tmp_path):
    out, run = str(tmp_path), RunContext("one", AS_OF)
    source = q_plan.affinity_source(r.club_cards, r.id_map, r.consents, r.secondary_fans, customers.AFFINITY)
    empty = source.withColumn("isNew", F.lit(0)).where("false")
    first = read_table(spark, q_plan.run_affinity(empty, source, run, out))
    assert first.where("isNew = 1").count() == source.count()
    second = read_table(spark, q_plan.run_affinity(first, source, RunContext("two", AS_OF), out))
    assert rows(second.drop("ProxyUserID")) == rows(first.drop("ProxyUserID"))
    t = q_plan.QuarantineTables(
        r.pending_debit, r.pending_credit, r.quarantine_log, r.id_map, r.people, r.mcc, r.inbound_times, r.locations, r.merchant_zips, r.duplicate_cins
    )
    feed = q_plan.run_quarantine(t, r.affinity_customers, 9, run, out)
    held = read_table(spark, f"{out}/quarantine_row_log")
    pure = q_plan.normalise_quarantine(
        q_plan.hold_debit(t.pending_debit, r.affinity_customers, t.row_log), q_plan.hold_credit(t.pending_credit, r.affinity_customers, t.row_log),
        r.affinity_customers, t.mcc, t.times,
    )
    whole = q_plan.quarantine_feed(pure, t.id_map, t.customers, t.locations, t.merchant_zips, t.duplicate_cins, 9, AS_OF)
    assert rows(read_table(spark, feed)) == rows(whole)
    assert held.count() >= read_table(spark, feed).count() > 0
    done = dataclasses.replace(t, row_log=t.row_log.union(held.select("FileID", "RowNum")))
    again = q_plan.run_quarantine(done, r.affinity_customers, 9, RunContext("two", AS_OF), str(tmp_path / "again"))
    assert read_table(spark, again, feed_schema(spark, feed)).count() == 0


def feed_schema(spark, path):
    return spark.read.parquet(path).schema


def test_direct_debit_run(spark, r, tmp_path):
    out = str(tmp_path)
    # Two lists of masked brands and two transaction tables, so that a mix-up shows.
    other_mask = r.brand_mask.where("BrandID % 2 = 0").withColumn("BrandName", F.lit("another name"))
    programme = r.dd_tx.where("FileID % 2 = 1")
    t = dd_plan.DirectDebitTables(
        r.dd_tx, programme, r.dd_log, r.people, r.pii, r.id_map, r.duplicate_ids, r.post_areas, r.bank_accounts, r.dd_merchants,
        r.brands, r.sectors, r.sector_groups, r.brand_mask, other_mask, r.earlier_customers, r.affinity_customers, r.cards,
        r.historic_accounts, r.id_overrides,
    )
    paths = dd_plan.run_direct_debit(t, direct_debit.CONFIG, RunContext("one", AS_OF), out)
    saved = {name: read_table(spark, path) for name, path in paths.items()}
    details = dd.dd_merchant_details(r.dd_merchants, r.brands, r.brand_mask, programme, r.earlier_customers)
    assert rows(saved["dd_merchant_details"]) == rows(dd.drop_unbranded_duplicates(details, "ProxyOINTupleID", direct_debit.CONFIG.unbranded_brand))
    assert rows(saved["dd_merchants_by_id"]) == rows(dd.dd_merchants(r.dd_merchants, r.brands, other_mask, keyed_by_id=True))
    assert rows(saved["brand_taxonomy"]) == rows(dd.brand_taxonomy(r.dd_merchants, r.brands, r.sectors, r.sector_groups, r.brand_mask))
    mapping = dd.proxy_mapping(
        programme, r.people, r.id_map, r.earlier_customers, r.affinity_customers, r.cards, r.bank_accounts, r.historic_accounts,
        r.id_overrides, r.duplicate_ids,
    )
    assert rows(saved["proxy_mapping"]) == rows(mapping)
    assert saved["proxy_mapping_files"].first()["filecount"] == 1
    pure = dd_plan.direct_debit_rows(t, dd.dd_eligible(r.dd_tx, r.people, r.dd_log, direct_debit.CONFIG), direct_debit.CONFIG, RunContext("one", AS_OF))
    assert rows(saved["feed"]) == rows(pure)
    log = read_table(spark, f"{out}/dd_row_log")
    assert log.count() == read_table(spark, paths["feed"]).count() > 0
    by_key = dd.drop_unbranded_duplicates(dd.dd_merchants(r.dd_merchants, r.brands, other_mask), "ProxyOINTupleID", direct_debit.CONFIG.unbranded_brand)
    assert rows(saved["dd_merchants"]) == rows(by_key)
    done = dataclasses.replace(t, row_log=t.row_log.union(log.select("FileID", "RowNum")))
    assert dd_plan.dd_eligible(done.transactions, done.customers, done.row_log, direct_debit.CONFIG).join(log, ["FileID", "RowNum"], "left_semi").count() == 0


def test_dimension_runs(spark, r, tmp_path):
    out, run = str(tmp_path), RunContext("one", AS_OF)
    cohorts = dims.CohortTables(
        addresses.state(r), r.people, r.pii, r.details, r.id_map, r.paf, r.cohort_addresses, r.cohort_defaults
    )
    saved = read_table(spark, dims.run_cohorts(cohorts, run, out))
    assert saved.where("UnhashedAddress IS NOT NULL").count() > 0
    kept = f"{out}/kept"
    saved.write.parquet(kept)
    state = read_table(spark, kept)
    assert len(folders(spark, f"{work_dir(spark)}/one/cohorts-*")) >= 5
    assert read_table(spark, dims.purge_cohorts(saved, run, out)).columns == state.columns
    left = [*folders(spark, f"{out}/cohort_state/version=*"), *folders(spark, f"{work_dir(spark)}/one/cohorts-*")]
    assert len(left) >= 7 and all(spark.read.parquet(p).count() == 0 for p in left)
    t = dims.CustomerTables(
        r.people, r.details, r.id_map, r.acorn, r.cameo, r.cameo_group, state, r.duplicate_ids, r.excluded_ids
    )
    feed = read_table(spark, dims.run_customers(t, run, out))
    detailed = read_table(spark, dims.run_customers(t, run, out, detailed=True))
    assert detailed.where("postcode IS NOT NULL").count() > 0 and set(feed.columns) == set(detailed.columns) - {"postcode"}
    assert rows(detailed.select("cinid", "hdi_ageband", "inprogram")) == rows(feed.select("cinid", "hdi_ageband", "inprogram"))
    assert feed.select("cinid").distinct().count() == r.id_map.count()
    merchants = dims.MerchantTables(
        r.merchants, r.merchants_before, r.merchants, r.merchant_postcode, r.alternates, r.alternate_locations, r.narrative_cache, r.mcc
    )
    paths = dims.run_merchants(merchants, run, out)
    cache = read_table(spark, paths["narrative_cache"])
    assert cache.count() > r.narrative_cache.count()
    again = dims.run_merchants(dataclasses.replace(merchants, narrative_cache=cache), RunContext("two", AS_OF), out)
    assert read_table(spark, again["narrative_cache"]).count() == cache.count()
    events = dims.AddressTables(r.address_events, r.external_ids, r.id_map, r.pii, r.duplicate_ids, r.excluded_ids)
    history = dims.run_address_history(events, addresses.SOURCES, EVENTS_FROM, run, out)
    assert read_table(spark, history).count() > 0


def scanned(df) -> int:
    """Rows that the scans of a plan gave after a run of it."""
    df.collect()

    def walk(node) -> int:
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.finalPhysicalPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec":
            return node.metrics().get("numOutputRows").get().value()
        children = node.children()
        return sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


@pytest.fixture
def files(spark, tmp_path):
    """A log of 100 files in 100 row groups of their own."""
    log = spark.range(10_000).select((F.col("id") / 100).cast("int").alias("FileID"), (F.col("id") % 100).cast("int").alias("RowNum"))
    log.repartitionByRange(100, "FileID").write.parquet(str(tmp_path / "log"))
    return read_table(spark, str(tmp_path / "log"))


def test_only_the_files_of_a_batch_are_read_from_the_log(spark, files, frame):
    batch = frame("FileID int, RowNum int", (50, 1), (51, 200), (51, 3))
    cut = exclude_logged(batch, files, prune_by="FileID")
    assert rows(cut) == [(51, 200)] and scanned(cut) <= 600
    assert scanned(within(files, batch, "FileID")) <= 600


def test_a_backfill_over_years_reads_its_own_files_only(spark, files, frame):
    batch = frame("FileID int, RowNum int", (1, 1), (1, 500), (98, 7), (None, 3))
    ranges = key_ranges(batch, "FileID")
    assert ranges == [(1, 1), (98, 98)]
    cut = exclude_logged(batch, in_ranges(files, "FileID", ranges))
    assert rows(cut) == [(1, 500), (None, 3)] and scanned(cut) <= 900
    assert key_ranges(batch.where("false"), "FileID") == [] and in_ranges(files, "FileID", []).count() == 0
    many = spark.range(5000).select((F.col("id") * 7).alias("FileID"))
    found = key_ranges(many, "FileID")
    assert len(found) <= 64 and in_ranges(many, "FileID", found).count() == 5000


def test_a_history_in_order_of_customers_is_read_by_ranges(spark, frame, tmp_path):
    n = 60_000
    tx = spark.range(n).select(
        (F.col("id") % 3_000).cast("int").alias("CINID"),
        F.expr("date_add(date'2023-01-01', cast(id % 300 as int))").alias("TranDate"),
        F.lit(1).alias("FileID"),
        F.col("id").cast("int").alias("RowNum"),
        F.xxhash64("id").alias("Amount"),
    )
    path = write_clustered(tx, f"{tmp_path}/tx", "CINID", tasks=8, group_bytes=1 << 14)
    debit = read_table(spark, path)
    none, as_of = debit.where("false"), datetime(2024, 3, 1)
    read = []
    for ids in ([5], [5, 1700, 2990]):
        eligible = frame("cinid int", *[(i,) for i in ids])
        plain = inc.eligible_history(debit, none, eligible, as_of)
        cut = inc.eligible_history(debit, none, eligible, as_of, prune_ids=True)
        assert rows(cut) == rows(plain) and cut.count() == 20 * len(ids)
        read.append(scanned(cut) - scanned(inc.eligible_history(none, none, eligible, as_of)))
    assert read[0] < read[1] < n / 2
    monthly = write_clustered(tx, f"{tmp_path}/months", "CINID", tasks=4, months_of="TranDate")
    assert rows(read_table(spark, monthly).drop("month").limit(5).select("CINID").distinct()) and len(folders(spark, f"{monthly}/month=*")) == 10
    assert inc.eligible_history(read_table(spark, monthly).drop("month"), none, frame("cinid int", (7,)), as_of, prune_ids=True).count() == 20
    assert inc.eligible_history(debit, none, frame("cinid int"), as_of, prune_ids=True).count() == 0


def test_tables_in_the_same_buckets_are_not_shuffled(spark, r, tmp_path):
    keys = ["FileID", "RowNum"]
    tables = {"b_tx": r.debit_holding, "b_log": r.row_log, "b_detailed": r.row_log_detailed, "b_times": r.tran_time}
    held = {k: write_bucketed(df, k, f"{tmp_path}/{k}", keys, 8) for k, df in tables.items()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = exclude_logged(held["b_tx"], held["b_log"], held["b_detailed"], colocated=True)
        timed = attach_time(fresh, held["b_times"], round_down=False)
        plain = attach_time(exclude_logged(r.debit_holding, r.row_log, r.row_log_detailed), r.tran_time, round_down=False)
        assert rows(timed) == rows(plain) and timed.count() > 0
        plan = timed._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Scan parquet spark_catalog.default.b_") >= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in held:
            spark.sql(f"DROP TABLE {name}")


def test_text_survives_csv(spark, frame, tmp_path):
    odd = ["", "line1\nline2", " pad ", None, "\\N", "\\n", 'quo"te,comma', '"', "a\\", "\r", "\\b\n\\"]
    df = frame("i int, t string, u string", *[(i if i else None, t, t) for i, t in enumerate(odd)])
    path = export_feed(df, str(tmp_path / "x"), date(2024, 1, 2), file_format="csv")
    assert sum(len(p.read_text().splitlines()) for p in Path(path).glob("part-*")) == len(odd)
    assert rows(import_files(spark, path, df.schema, exported=True)) == rows(df)


@pytest.mark.parametrize("line", ["foo,x", "1,x,surplus", "1"])
def test_a_bad_row_fails_the_import(spark, tmp_path, line):
    (tmp_path / "p.csv").write_text(f"1,a\n{line}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        import_files(spark, str(tmp_path), "i int, t string").collect()


def test_cohort_ingest_and_staging(spark, r, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("h1,5\nh2,6\n")
    path = dims.run_cohort_ingest(spark, str(tmp_path / "in"), "hashed_address string, cohort_id int", RunContext("one", AS_OF), str(tmp_path))
    assert rows(read_table(spark, path)) == [("h1", 5), ("h2", 6)]
    t = card_plan.StagingTables(r.debit_holding, r.credit_holding, r.debit_holding.where("RowNum % 2 = 0"), r.credit_holding.where("false"))
    paths = card_plan.run_staging(t, RunContext("one", AS_OF), str(tmp_path))
    debit = read_table(spark, paths["debit"])
    assert debit.count() == r.debit_holding.where("RowNum % 2 = 1").count() > 0
    assert {x["PaymentTypeID"] for x in debit.select("PaymentTypeID").distinct().collect()} == {1}
    assert read_table(spark, paths["credit"]).count() == r.credit_holding.count()


def test_bad_rows_are_put_aside(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = [f"h{i},{i},2024-01-{i % 28 + 1:02d}" for i in range(200)]
    (folder / "a.csv").write_text("\n".join([*good[:50], "x,notanumber,2024-01-01", *good[50:90], "short,1", '"q,1",2,later', *good[90:]]) + "\n")
    (folder / "b.csv").write_text('a,1,2024-01-01,more\n"ok, too",7,\n')
    schema = spark.createDataFrame([], "hashed_address string, cohort_id int, d date").schema
    split = import_split(spark, str(folder), schema, "one", most_bad=0.05)
    assert split.good.count() == 201 and split.good.schema == schema
    found = sorted((r["file"].rsplit("/", 1)[1], r["record"], r["reason"], r["line"]) for r in split.rejects.collect())
    assert found == [
        ("a.csv", 51, "cohort_id", "x,notanumber,2024-01-01"),
        ("a.csv", 92, "fields", "short,1"),
        ("a.csv", 93, "d", '"q,1",2,later'),
        ("b.csv", 1, "fields", "a,1,2024-01-01,more"),
    ]
    with pytest.raises(TooManyRejects, match="4 of 205"):
        import_split(spark, str(folder), schema, "two", most_bad=0.01)


def test_ingest_of_both_partner_files_is_logged(spark, tmp_path):
    folder, said, out = tmp_path / "in", tmp_path / "said", str(tmp_path / "out")
    folder.mkdir()
    said.mkdir()
    (folder / "a.csv").write_text("AB1 2CD,5\nbad,x\nXY9 8ZZ,6\n")
    (said / "a.txt").write_text("one file\n")
    run, schema = RunContext("one", AS_OF), "Postcode_Trim string, cohort_ID int"
    with pytest.raises(Exception):
        dims.run_default_ingest(spark, str(folder), schema, run, out)
    path = dims.run_default_ingest(spark, str(folder), schema, run, out, output=str(said), most_bad=0.5)
    assert rows(read_table(spark, path)) == [("AB1 2CD", 5), ("XY9 8ZZ", 6)]
    assert spark.read.parquet(f"{out}/cohort_defaults_rejects").first()["line"] == "bad,x"
    assert spark.read.parquet(f"{out}/run_log").first()["Msg"] == "one file"
    (said / "a.txt").write_text("Traceback\n")
    with pytest.raises(log_plan.ExportFailed):
        dims.run_cohort_ingest(spark, str(folder), schema, RunContext("two", AS_OF), out, output=str(said))
    assert not folders(spark, f"{out}/cohorts/*")


def test_cohorts_are_exported_for_the_partner(spark, r, tmp_path):
    state = addresses.state(r)
    said = tmp_path / "said"
    said.mkdir()
    (said / "a.txt").write_text("sent\n")
    target = dims.run_cohort_export(spark, state, RunContext("one", AS_OF), str(tmp_path / "out"), rows_per_file=100, deliver=lambda path: str(said))
    current = state.where("isCurrentCohort = 1").count()
    assert spark.read.parquet(target).count() == current > 0
    assert exported_files(spark, target).count() == -(-current // 100)
    assert spark.read.parquet(f"{tmp_path}/out/run_log").count() == 1


def test_a_run_with_a_log_of_runs_delivers_the_same(spark, r, tmp_path):
    t = card_tables(r)
    plain = card_plan.run_card_feed(spark, t, RunContext("one", AS_OF), str(tmp_path / "a"))
    runs = dataclasses.replace(t, row_log=row_runs(t.row_log))
    other = card_plan.run_card_feed(spark, runs, RunContext("one", AS_OF), str(tmp_path / "b"))
    assert rows(read_table(spark, other["feed"])) == rows(read_table(spark, plain["feed"]))
    logged = spark.read.parquet(f"{tmp_path}/b/standard_row_log").drop("run")
    assert rows(expanded(logged)) == rows(spark.read.parquet(f"{tmp_path}/a/standard_row_log").select("FileID", F.col("RowNum").cast("long")).distinct())
    assert published(spark, f"{tmp_path}/b/published/standard")["feed"] == [other["feed"]]


def test_log_ids_do_not_repeat_over_files(spark, tmp_path):
    for name, text in (("a", "one\n\ntwo\n"), ("b", "three\nfour"), ("c", "five\n")):
        (tmp_path / f"{name}.txt").write_text(text)
    got = read_run_output(spark, str(tmp_path), 3).orderBy("LogID").collect()
    assert [x["Msg"] for x in got] == ["one", None, "two", "three", "four", "five"]
    assert len({x["LogID"] for x in got}) == 6


def test_a_failed_delivery_is_logged_and_the_rows_are_not(spark, r, tmp_path):
    out, t = str(tmp_path / "out"), card_tables(r)
    said = tmp_path / "said"
    said.mkdir()
    (said / "a.txt").write_text("sent part one\n")
    (said / "b.txt").write_text("Traceback: no space\nstopped\n")
    with pytest.raises(log_plan.ExportFailed, match="no space stopped"):
        card_plan.run_card_feed(spark, t, RunContext("one", AS_OF), out, deliver=lambda path: str(said))
    assert not folders(spark, f"{out}/standard_row_log/*")
    lines = spark.read.parquet(f"{out}/run_log")
    assert lines.where("isError").count() == 3 and spark.read.parquet(f"{out}/error_summaries").count() == 1
    assert spark.read.parquet(f"{out}/left_over_lines").count() == 3
    (said / "b.txt").write_text("all sent\n")
    card_plan.run_card_feed(spark, t, RunContext("two", AS_OF), out, deliver=lambda path: str(said))
    assert len(folders(spark, f"{out}/standard_row_log/*")) == 1
    assert flag_error_runs(lines.drop("isError", "CreatedDateTime", "run")).count() == 3
