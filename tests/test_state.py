"""State that is written part by part: buckets, publication, exact export, purge and daily address history."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cardloom.config import RunContext
from cardloom.operators import affinity, history as h, merchant
from cardloom.operators.direct_debit import export_file_count
from cardloom.plans.dimensions import address_state, run_address_history_daily
from cardloom.sources import files
from cardloom.sources.buckets import BucketedState
from cardloom.sources.publish import publish, published, read_published, versions
from cardloom.sources.tables import LeftBehind, empty_tables, folders
from tests.conftest import rows

DAY = date(2024, 1, 2)


def state_of(spark, root, schema="id long, v string", keys=("id",), **more) -> BucketedState:
    return BucketedState(spark, str(root), spark.createDataFrame([], schema).schema, keys, **more)


def written(root) -> set[str]:
    return {str(p) for p in Path(root).glob("data/run=*/_bucket=*")}


def test_one_changed_key_rewrites_one_bucket(spark, tmp_path, frame):
    state = state_of(spark, tmp_path, buckets=8)
    first = [(i, f"v{i}") for i in range(200)] + [(None, "none"), (7, "again")]
    state.write(frame("id long, v string", *first), "1")
    before = written(tmp_path)
    assert len(before) == 8 and rows(state.read()) == sorted(first, key=repr)
    assert len(state.upsert(frame("id long, v string", (7, "new")), "2")) == 1
    assert len(written(tmp_path) - before) == 1 and before <= written(tmp_path)
    after = [r for r in first if r[0] != 7] + [(7, "new")]
    assert rows(state.read()) == sorted(after, key=repr) and rows(state.read("1")) == sorted(first, key=repr)
    assert len(set(state.manifest("1").items()) & set(state.manifest("2").items())) == 7
    assert rows(state.rows_of(frame("id long", (7,), (9,), (999,)))) == [(7, "new"), (9, "v9")]


def test_updates_equal_a_plain_rewrite(spark, tmp_path, frame):
    rnd = random.Random(2)
    state, plain = state_of(spark, tmp_path, buckets=5, files_per_bucket=2), {}
    state.write(frame("id long, v string"), "0")
    assert state.read().count() == 0
    for n in range(1, 5):
        new = {rnd.randrange(40): f"{n}-{rnd.random()}" for _ in range(8)}
        state.upsert(frame("id long, v string", *new.items()), str(n))
        plain |= new
        gone = rnd.sample(sorted(plain), 3)
        state.delete(frame("id long", *[(k,) for k in gone]), f"{n}-gone")
        plain = {k: v for k, v in plain.items() if k not in gone}
        assert rows(state.read()) == sorted(plain.items(), key=repr)
    with pytest.raises(ValueError):
        state.upsert(frame("id long, v string", (1, "x")), "4")


def test_a_failed_update_leaves_the_state(spark, tmp_path, frame):
    state = state_of(spark, tmp_path)
    state.write(frame("id long, v string", (1, "a"), (2, "b")), "1")
    broken = frame("id long, v string", (1, "c")).withColumn("v", F.raise_error(F.lit("stopped")).cast("string"))
    with pytest.raises(Exception, match="stopped"):
        state.upsert(broken, "2")
    assert rows(state.read()) == [(1, "a"), (2, "b")] and list(versions(spark, state.manifests)) == ["1"]
    state.upsert(frame("id long, v string", (1, "c")), "2")
    assert rows(state.read()) == [(1, "c"), (2, "b")]


def test_bucketed_upserts_equal_the_whole_ones(spark, tmp_path, frame):
    schema = "FanID long, CINID long, PostcodeDistrict string, PostalArea string, Chksum long, isNew int"
    target = frame(schema, (1, 11, "A", "a", 5, 0), (1, 12, "B", "a", 6, 0), (2, None, "C", "c", 7, 0), (3, 13, "D", None, 8, 0), (None, 14, "E", "e", 9, 0))
    new = "FanID long, CINID long, PostcodeDistrict string, PostalArea string, Chksum long"
    source = frame(new, (1, 11, "Z", "z", 6), (2, None, "C", "c", 7), (4, 13, "X", "x", 1), (5, 15, "Y", "y", 2), (6, None, "W", "w", 3), (6, None, "W", "w", 3))
    state = BucketedState(spark, f"{tmp_path}/c", target.schema, ("FanID",), buckets=4)
    state.write(target, "1")
    stage = lambda df, name: df
    affinity.upsert_changed_state(state, source, "2", stage)
    assert rows(state.read()) == rows(affinity.upsert_changed(target, source))
    schema = "ConsumerCombinationID long, BrandID int, MID string, Narrative string"
    old = frame(schema, (1, 5, "m", "n"), (1, 6, "m", "n"), (2, None, "m", "n"), (3, 7, "m", "n"), (4, 1, "q", "r"))
    up = frame(schema, (1, 6, "m", "n"), (2, 3, "m", "n"), (3, 8, "m,", "n"), (3, 9, "m", "n"), (9, 1, "a,b", ",c"), (None, 2, "x", "y"))
    merchants = BucketedState(spark, f"{tmp_path}/m", old.schema, ("ConsumerCombinationID",), buckets=4)
    merchants.write(old, "1")
    merchant.upsert_merchants_state(merchants, up, "2", stage)
    assert rows(merchants.read()) == rows(merchant.upsert_merchants(old, up))


def test_outputs_become_visible_together(spark, tmp_path):
    root, data = f"{tmp_path}/published", f"{tmp_path}/data"
    assert published(spark, root) == {}
    for n in (1, 2):
        spark.range(n).write.parquet(f"{data}/a{n}")
        if n == 1:
            publish(spark, root, "one", {"a": f"{data}/a1", "b": [f"{data}/a1", f"{data}/x"]})
    # The second run stops before its manifest: readers see the first.
    assert read_published(spark, root, "a").count() == 1
    assert published(spark, root)["b"] == [f"{data}/a1", f"{data}/x"]
    publish(spark, root, "two", {"a": f"{data}/a2"})
    assert read_published(spark, root, "a").count() == 2 and read_published(spark, root, "a", "one").count() == 1
    with pytest.raises(ValueError):
        publish(spark, root, "one", {})
    publish(spark, root, "one", {"a": f"{data}/a1"}, again=True)
    assert list(versions(spark, root)) == ["two", "one"] and read_published(spark, root, "a").count() == 1


@pytest.mark.parametrize("n,parts,size", [(1000, 7, 300), (1000, 1, 300), (900, 13, 300), (5, 3, 300), (0, 2, 10), (10, 2, 1)])
@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_exact_export(spark, tmp_path, n, parts, size, kind):
    df = spark.range(n).repartition(parts).withColumns({"t": F.concat(F.lit("a\n,\""), "id"), "d": F.lit(DAY), "x": F.when(F.col("id") % 2 == 0, F.col("id") / 3)})
    target = files.export_exact(df, f"{tmp_path}/out", DAY, rows_per_file=size, file_format=kind)
    manifest = rows(files.exported_files(spark, target))
    count = export_file_count(df, size).first()[0]
    assert [(r[0], r[2]) for r in manifest] == [(i, min(size, n - size * i)) for i in range(count)]
    back = files.import_files(spark, target, df.schema, file_format=kind, exported=True)
    assert rows(back) == rows(df)
    assert len([p for p in Path(target).glob("part-*")]) == max(1, count)


def test_an_export_without_a_manifest_is_not_complete(spark, tmp_path):
    target = files.export_feed(spark.range(3), f"{tmp_path}/out", DAY)
    with pytest.raises(files.IncompleteExport):
        files.exported_files(spark, target)


def test_numbers_without_gaps(spark, tmp_path):
    spark.range(0, 500, 1, 6).write.parquet(f"{tmp_path}/t")
    found = files.numbered(spark.read.parquet(f"{tmp_path}/t"), "n")
    assert sorted(r["n"] for r in found.collect()) == list(range(500))
    assert rows(found) == rows(found.repartition(3))


def test_purge_goes_on_past_what_an_interrupted_write_left(spark, tmp_path, monkeypatch):
    for name in ("a", "c"):
        spark.range(3).write.parquet(f"{tmp_path}/x-{name}")
    left = tmp_path / "x-b" / "_temporary" / "0" / "task"
    left.mkdir(parents=True)
    (left / "part-0.parquet").write_bytes(b"address")
    (tmp_path / "x-d").mkdir()
    (tmp_path / "x-d" / "part-1.parquet").write_bytes(b"no footer")
    emptied = empty_tables(spark, f"{tmp_path}/x-*")
    assert [p.rsplit("-", 1)[1] for p in emptied] == ["a", "b", "c", "d"]
    assert not [p for p in tmp_path.rglob("*") if p.is_file() and p.read_bytes() in (b"address", b"no footer")]
    assert sum(spark.read.parquet(p).count() for p in emptied) == 0
    # One that cannot be emptied is told at the end, after the others.
    spark.range(3).write.parquet(f"{tmp_path}/y-b")
    (tmp_path / "y-a").mkdir()
    from pyspark.sql.readwriter import DataFrameWriter

    plain = DataFrameWriter.parquet

    def refuse(self, path, *args, **kwargs):
        if path.endswith("y-a"):
            raise OSError("no permission")
        return plain(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", refuse)
    with pytest.raises(LeftBehind, match="y-a"):
        empty_tables(spark, f"{tmp_path}/y-*")
    assert spark.read.parquet(f"{tmp_path}/y-b").count() == 0 and len(folders(spark, f"{tmp_path}/y-*")) == 2


EVENT = "event_id long, CustomerGUID string, LoadDate timestamp_ntz, UpdatedAt timestamp_ntz, PostCode string"
TIE = ("event_id",)


def some_events(seed: int, n: int):
    rnd = random.Random(seed)
    at = datetime(2024, 1, 1)
    out = []
    for i in range(n):
        at += timedelta(hours=rnd.choice([0, 5, 30]))
        who = rnd.choice(["a", "b", "c", "d", None, "hot", "hot", "hot"])
        moved = rnd.choice([None, at, at, at - timedelta(days=rnd.randrange(6)), datetime(2024, 1, 3)])
        out.append((i, who, at, moved, rnd.choice(["AB1 2CD", "AB1", None, "XY9 8ZZ"])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_daily_history_equals_one_run(spark, tmp_path, seed):
    events = some_events(seed, 90)
    start = date(2024, 1, 4)
    df = spark.createDataFrame(events, EVENT)
    whole = h.validity_intervals(h.changed_rows(df, start, tie=TIE), tie=TIE)
    days = sorted({e[2] for e in events})
    cuts = [days[len(days) * i // 4] for i in range(1, 4)]
    for i, (low, high) in enumerate(zip([datetime.min, *cuts], [*cuts, datetime.max])):
        part = [e for e in events if low < e[2] <= high]
        day = spark.createDataFrame(part, EVENT)
        run_address_history_daily(spark, day, start, RunContext(f"day{i}", datetime(2024, 2, 1)), f"{tmp_path}/h", TIE, work=f"{tmp_path}/w")
        with pytest.raises(ValueError):
            run_address_history_daily(spark, day, start, RunContext(f"day{i}", datetime(2024, 2, 1)), f"{tmp_path}/h", TIE, work=f"{tmp_path}/w")
        state = address_state(spark, f"{tmp_path}/h")
        found = state.closed.unionByName(state.open.withColumn("NextUpdatedAt", F.lit(None).cast("timestamp_ntz")))
        so_far = spark.createDataFrame([e for e in events if e[2] <= high], EVENT)
        wanted = h.validity_intervals(h.changed_rows(so_far, start, tie=TIE), tie=TIE)
        assert rows(found.select(*wanted.columns)) == rows(wanted)
    assert rows(found.select(*whole.columns)) == rows(whole)


def test_a_day_reads_its_own_events_only(spark, tmp_path):
    start, root = date(2024, 1, 1), f"{tmp_path}/h"
    events = some_events(3, 60)
    for i in range(2):
        spark.createDataFrame(events[i * 30 : i * 30 + 30], EVENT).write.parquet(f"{tmp_path}/events{i}")
        run_address_history_daily(spark, spark.read.parquet(f"{tmp_path}/events{i}"), start, RunContext(str(i), datetime(2024, 2, 1)), root, TIE, work=f"{tmp_path}/w{i}")
    state = address_state(spark, root)
    assert not [f for df in (state.carried, state.open, state.closed) for f in df.inputFiles() if "events" in f]
