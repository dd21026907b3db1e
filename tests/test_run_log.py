"""Run logs against brute force, with small blocks so that cutting matters."""

from __future__ import annotations

import random
from datetime import date, datetime

import pytest

from cardloom.operators import run_log as log
from cardloom.sources.files import read_run_output
from tests.conftest import rows

LINES = "RunID int, LogID long, Msg string"


def test_flag_is_on_every_line_of_the_run(frame):
    df = frame(LINES, (1, 1, "fine"), (1, 2, "Error: x"), (2, 1, "last Error"), (2, 2, None), (3, 1, None))
    got = {(r["RunID"], r["LogID"]): r["isError"] for r in log.flag_error_runs(df).collect()}
    assert got == {(1, 1): True, (1, 2): True, (2, 1): False, (2, 2): False, (3, 1): False}


@pytest.mark.parametrize("max_len, block", [(30, 5), (60, 1), (60, 1000), (500, 7)])
def test_summary_is_the_end_of_the_text(frame, max_len, block):
    rng = random.Random(3)
    data = []
    for run in range(4):
        for i in range(rng.choice([3, 80])):
            data.append((run, i, rng.choice([None, "", "a", "line with words", "y" * rng.randrange(40)])))
        data.append((run, 1000, "Traceback"))
    data.append((9, 1, "all fine"))
    rng.shuffle(data)
    flagged = log.flag_error_runs(frame(LINES, *data))
    got = dict(rows(log.error_summary(flagged, pointer=".. run {run}", max_len=max_len, block=block)))
    assert set(got) == {0, 1, 2, 3}
    for run, summary in got.items():
        text = " ".join(m for r, i, m in sorted(data, key=lambda d: d[:2]) if r == run and m is not None)
        pointer = f".. run {run}"
        assert summary == text[-(max_len - len(pointer)) :] + pointer


def test_residual_lines_and_append(frame):
    df = frame(LINES, (1, 1, "done"), (1, 2, None), (1, 3, "left"))
    assert rows(log.residual_lines(df, ["done"], datetime(2024, 3, 1, 2))) == [(date(2024, 3, 1), "left")]
    flagged = log.flag_error_runs(df)
    earlier = frame("LogID long, RunID int, Msg string, CreatedDateTime timestamp_ntz, isError boolean", (1, 0, "x", datetime(2024, 2, 1), False))
    assert log.append_run_log(earlier, flagged, datetime(2024, 3, 1)).count() == 4


def test_run_output_keeps_line_order(spark, tmp_path):
    """Blocks are made tiny so that one file is read by many tasks."""
    lines = [f"line {i} " + "x" * (i % 17) for i in range(300)] + [""]
    (tmp_path / "out.txt").write_text("\n".join([*lines, "Error: last"]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        got = read_run_output(spark, str(tmp_path), 7)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
        ordered = [r["Msg"] for r in got.orderBy("LogID").collect()]
        assert ordered == [*lines[:-1], None, "Error: last"]
        assert got.select("LogID").distinct().count() == len(ordered)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    summary = log.error_summary(log.flag_error_runs(got), pointer="!", max_len=30)
    assert rows(summary) == [(7, " ".join([*lines[:-1], "Error: last"])[-29:] + "!")]
