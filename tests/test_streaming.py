"""Streamed freshness against the batch check, with late rows, restarts and nothing at all."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairn.operators import quality as q
from cairn.streaming import announce, arrived, read_arrivals, streamed_freshness, watch
from cairn.streaming.freshness import ARRIVALS

NOW = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")


def day(n, hour=0):
    return dt.datetime(2024, 1, n, hour)


@pytest.fixture
def load(spark, tmp_path):
    """Announces times as one more file of a table and takes them in."""
    def add(table, *times):
        folder = tmp_path / table
        (folder / "in").mkdir(parents=True, exist_ok=True)
        if times:
            announce(spark.createDataFrame([(t,) for t in times], ARRIVALS).coalesce(1), "loaded_at", str(folder / "in"))
        watch(read_arrivals(spark, str(folder / "in"), files_per_batch=1), str(folder))
        return str(folder)
    return add


def test_status_equals_batch_check(spark, rows, load):
    told = {"trips": [[day(1), day(1, 5)], [day(9, 18), None], [day(4, 9), day(9, 3)]], "fees": [[day(8)], [day(2), day(1)]], "never": [[]]}
    hours = {"trips": (12.0, 24.0), "fees": (12.0, 72.0), "never": (12.0, 24.0)}
    roots = {name: [load(name, *part) for part in parts][-1] for name, parts in told.items()}
    frames = {name: spark.createDataFrame([(t,) for t in sum(parts, [])], ARRIVALS) for name, parts in told.items()}
    batch = q.freshness({name: (df, "loaded_at", *hours[name]) for name, df in frames.items()}, NOW)
    streamed = streamed_freshness(spark, {name: (root, *hours[name]) for name, root in roots.items()}, NOW)
    assert streamed.schema == batch.schema
    assert rows(streamed) == rows(batch)
    assert rows(streamed, "table_name", "status") == [("fees", "warn"), ("never", "error"), ("trips", "pass")]


def test_late_rows_are_in_no_window(spark, rows, load):
    for n in (1, 8):
        load("trips", day(n), day(n))
    root = load("trips", day(9, 18))
    assert rows(arrived(spark, root), "window_start", "n_rows") == [(day(1), 2), (day(8), 2), (day(9), 1)]
    load("trips", day(1, 7), day(2))
    assert rows(arrived(spark, root), "window_start", "n_rows") == [(day(1), 2), (day(8), 2), (day(9), 1)]
    # a row within the delay still counts
    load("trips", day(9, 3))
    assert rows(arrived(spark, root)) == [(day(1), 2, day(1)), (day(8), 2, day(8)), (day(9), 2, day(9, 18))]


def test_closed_windows_leave_the_state(spark, rows, load):
    for n in range(1, 7):
        root = load("trips", day(n), day(n, 1))
    assert spark.read.format("statestore").load(f"{root}/progress").count() <= 2
    assert rows(arrived(spark, root), "window_start", "n_rows") == [(day(n), 2) for n in range(1, 7)]


def test_a_run_without_news_changes_nothing(spark, rows, load):
    load("trips", day(3), day(3))
    load("trips")
    assert rows(arrived(spark, load("trips")), "n_rows") == [(2,)]
