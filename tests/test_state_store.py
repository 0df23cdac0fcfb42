"""Stored month states: a changed chunk is folded alone, and the profile equals a full build."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from refrain.plans import features
from refrain.plans.state_store import StateStore, write_chunks

LOGS = "msno string, date date, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, total_secs double"


def log_rows(spark, days=60, members=4):
    """Two rows per member and day, some of them twice; whole seconds, so that sums do not depend on their order."""
    start = dt.date(2017, 1, 1)
    rows = [
        (f"m{m}", start + dt.timedelta(d), *[(d * 7 + m + k) % 11 - 1 for _ in range(6)], float(d % 5 + k))
        for m in range(members)
        for d in range(days)
        for k in (0, 0, 1)
        if (d + m) % 3
    ]
    logs = spark.createDataFrame(rows, LOGS)
    return logs.withColumn("chunk", F.date_format(F.date_trunc("week", "date"), "yyyy-MM-dd"))


def same(store, logs):
    whole, stored = features.profile_logs(logs.drop("chunk")), store.profile()
    assert whole.count() == stored.count() > 0
    assert whole.exceptAll(stored.select(whole.columns)).count() == 0


@pytest.fixture
def store(spark, tmp_path):
    return StateStore(spark, str(tmp_path / "logs"), str(tmp_path / "store"))


def test_states_equal_a_full_build_after_a_chunk_is_replaced(spark, store):
    logs = log_rows(spark)
    weeks = logs.select("chunk").distinct().count()
    write_chunks(logs, store.logs_path)
    assert store.refresh() == weeks
    same(store, logs)
    mended = logs.filter("chunk <> '2017-01-09' OR num_25 > 2")
    write_chunks(mended.filter("chunk = '2017-01-09'"), store.logs_path)
    assert store.refresh() == 1
    same(store, mended)


def test_a_rerun_adds_nothing(spark, store):
    write_chunks(log_rows(spark, 20), store.logs_path)
    store.refresh()
    steps, before = store.steps(), sorted(map(str, store.states().collect()))
    assert store.refresh() == 0
    assert store.steps() == steps and sorted(map(str, store.states().collect())) == before


def test_a_new_chunk_is_added_and_a_deleted_one_leaves(spark, store, tmp_path):
    logs = log_rows(spark, 30)
    write_chunks(logs.filter("chunk < '2017-01-16'"), store.logs_path)
    store.refresh()
    write_chunks(logs.filter("chunk >= '2017-01-16'"), store.logs_path)
    assert store.refresh() == logs.filter("chunk >= '2017-01-16'").select("chunk").distinct().count()
    same(store, logs)
    for file in (tmp_path / "logs" / "chunk=2017-01-02").iterdir():
        file.unlink()
    assert store.refresh() == 0
    same(store, logs.filter("chunk <> '2017-01-02'"))


def test_a_refresh_that_died_changes_nothing_until_it_is_run_again(spark, store, monkeypatch):
    logs = log_rows(spark, 20)
    write_chunks(logs, store.logs_path)
    store.refresh()
    late = log_rows(spark, 20, 6).filter("chunk = '2017-01-09'")
    write_chunks(late, store.logs_path)
    fold = StateStore._fold

    def die(self, changed):
        fold(self, changed)
        raise RuntimeError("lost")

    monkeypatch.setattr(StateStore, "_fold", die)
    with pytest.raises(RuntimeError):
        store.refresh()
    same(store, logs)  # states of the new version lie there and do not count
    monkeypatch.setattr(StateStore, "_fold", fold)
    assert store.refresh() == 1
    same(store, logs.filter("chunk <> '2017-01-09'").unionByName(late))


def test_sweep_leaves_the_newest_step_and_nothing_else(spark, store):
    logs = log_rows(spark, 20)
    write_chunks(logs, store.logs_path)
    store.refresh()
    write_chunks(logs.filter("chunk = '2017-01-09' AND num_25 > 0"), store.logs_path)
    store.refresh()
    assert len(store.steps()) == 2 and store.sweep() == 1
    assert len(store.steps()) == 1 and store.sweep() == 0
    same(store, logs.filter("chunk <> '2017-01-09' OR num_25 > 0"))


@pytest.mark.parametrize("name", ["007", "a b+c%d/e:f", "2017-01-01"])
def test_chunk_names_are_text(spark, store, name):
    logs = log_rows(spark, 9).withColumn("chunk", F.lit(name))
    write_chunks(logs, store.logs_path)
    assert store.refresh() == 1 and [r.chunk for r in store.ledger().collect()] == [name]
    same(store, logs)


def test_only_changed_chunks_are_read(spark, store):
    write_chunks(log_rows(spark, 30), store.logs_path)
    store.refresh()
    write_chunks(log_rows(spark, 30).filter("chunk = '2017-01-09'").limit(5), store.logs_path)
    before = {r.path for r in listing(spark, store)}
    store.refresh()
    fresh = {r.path for r in listing(spark, store)} - before
    assert fresh and all("chunk=2017-01-09/" in p for p in fresh)


def listing(spark, store):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{store.path}/states")
    return files.select("path").collect()


def test_a_store_without_states_says_so(spark, store):
    with pytest.raises(ValueError):
        store.states()
