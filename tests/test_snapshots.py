"""Commits that only one writer makes; tables changed by whole files; realized values written back."""

from __future__ import annotations

import threading
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import START, predictions as table
from tickloom.operators import monitor
from tickloom.operators import predictions as p
from tickloom.operators.versions import VersionLog
from tickloom.sources.snapshots import CommitLog, SnapshotTable, create_once


def prices(spark, rows):
    return spark.createDataFrame([(s, START + timedelta(seconds=at), float(v)) for s, at, v in rows], "symbol string, event_ts timestamp, price double")


def test_a_file_is_created_once(spark, tmp_path):
    path, won = str(tmp_path / "sub" / "one.json"), []
    writers = [threading.Thread(target=lambda i=i: won.append(i) if create_once(spark, path, f"{i}") else None) for i in range(8)]
    [w.start() for w in writers], [w.join() for w in writers]
    assert len(won) == 1 and Path(path).read_text() == str(won[0])
    assert [f.name for f in Path(path).parent.iterdir()] == ["one.json"]


def test_commits_of_two_writers(spark, tmp_path):
    one, two = CommitLog(spark, str(tmp_path / "log")), CommitLog(spark, str(tmp_path / "log"))
    assert one.latest() == 0 and one.commit(lambda last: None) == 0

    def slow(last):
        if last == 0:  # the other one commits in between
            two.commit(lambda n: {"by": "two"})
        return {"by": "one", "after": last}

    assert one.commit(slow) == 2
    assert [one.read(n) for n in one.numbers()] == [{"by": "two"}, {"by": "one", "after": 1}]
    assert one.rows("by string", upto=1).collect()[0]["by"] == "two"


def test_two_writers_register_different_versions(spark, tmp_path):
    logs, numbers = [VersionLog(spark, str(tmp_path / "versions")) for _ in range(2)], []
    writers = [threading.Thread(target=lambda log=log: numbers.extend(log.register("m", 0.5) for _ in range(2))) for log in logs]
    [w.start() for w in writers], [w.join() for w in writers]
    assert sorted(numbers) == [1, 2, 3, 4]
    rows = logs[0].read().collect()
    assert sorted(r["version"] for r in rows) == [1, 2, 3, 4] and len({r["seq"] for r in rows}) == 4


def rows(spark, values):
    return spark.createDataFrame([(i, f"s{i % 3}", START + timedelta(seconds=i), v) for i, v in values], "id long, symbol string, timestamp timestamp, v double")


def stored(spark, tmp_path):
    made = rows(spark, [])
    return SnapshotTable(spark, str(tmp_path / "t"), made.schema)


def content(df):
    return {r["id"]: r["v"] for r in df.collect()}


def test_upsert_rewrites_the_files_it_must(spark, tmp_path, sliced):
    sliced(6)
    t = stored(spark, tmp_path)
    assert t.read().count() == 0 and t.upsert(rows(spark, [])) == 0
    t.append(rows(spark, [(i, 1.0) for i in range(300)]))
    before = {r["path"]: r["n"] for r in t.files().collect()}
    assert len(before) > 3 and sum(before.values()) == 300
    assert t.upsert(rows(spark, [(3, 2.0), (6, 2.0), (900, 3.0)])) == 2
    after = {r["path"] for r in t.files().collect()}
    assert len(before.keys() - after) == 1  # both ids are in one file
    assert content(t.read()) == {**{i: 1.0 for i in range(300)}, 3: 2.0, 6: 2.0, 900: 3.0}
    assert content(t.read(1)) == {i: 1.0 for i in range(300)}  # the state before stays readable
    some = t.read(where=F.col("min_id") > 100).count()
    assert 0 < some < 301


def test_a_writer_that_was_overtaken_does_it_again(spark, tmp_path, monkeypatch):
    t, other = stored(spark, tmp_path), stored(spark, tmp_path)
    t.append(rows(spark, [(i, 1.0) for i in range(30)]))
    plain, overtaken = SnapshotTable._write, []

    def write(self, df):
        if not overtaken:
            overtaken.append(True)
            other.upsert(rows(spark, [(1, 5.0), (2, 5.0), (70, 5.0)]))
        return plain(self, df)

    monkeypatch.setattr(SnapshotTable, "_write", write)
    assert t.upsert(rows(spark, [(2, 7.0), (71, 7.0)])) == 3
    assert content(t.read()) == {**{i: 1.0 for i in range(30)}, 1: 5.0, 2: 7.0, 70: 5.0, 71: 7.0}
    folders = {r["path"].split("/")[1] for n in (1, 2, 3) for r in t.files(n).collect()}
    assert {f.name for f in (tmp_path / "t" / "data").iterdir()} == folders  # what the lost try wrote is gone


def test_expire_keeps_what_versions_hold(spark, tmp_path):
    t = stored(spark, tmp_path)
    for v in (1.0, 2.0, 3.0):
        t.upsert(rows(spark, [(i, v) for i in range(10)]))
    assert t.expire(keep=2) == 2 and content(t.read(2)) == {i: 2.0 for i in range(10)}
    assert t.expire() == 2 and content(t.read()) == {i: 3.0 for i in range(10)}


@pytest.mark.parametrize("way", ["fifo", "asof"])
def test_realized_values_are_written_back_once(spark, tmp_path, way):
    path = str(tmp_path / "predictions")
    waiting = table(spark, [(1, "A", 0, 100, 101, 0.01), (2, "A", 5, 100.8, 102, 0.01), (3, "B", 5, 50, 51, 0.02), (4, "C", 0, 1, 1, 0.0)])
    assert p.save_predictions(waiting, path) == 1
    stored = p.predictions_table(spark, path)
    seen = [("A", 0, 100), ("A", 5, 100.8), ("B", 9, 52)]

    def realize(more):
        known = prices(spark, seen + more)
        return p.realize_stored(stored, lambda df: (p.realize_fifo if way == "fifo" else p.realize_asof)(df, known))

    assert realize([]) == 2
    first = {r["id"]: (r["realized_error"], r["realized_at"]) for r in stored.read().collect()}
    assert first[1] == (pytest.approx(-0.2), START + timedelta(seconds=5)) and first[3] == (1.0, START + timedelta(seconds=9))
    assert first[2] == first[4] == (None, None)
    assert realize([]) == 2  # nothing new, no commit
    assert realize([("A", 8, 103)]) == 3
    second = {r["id"]: (r["realized_error"], r["realized_at"]) for r in stored.read().collect()}
    assert second == {**first, 2: (1.0, START + timedelta(seconds=8))}
    assert p.read_predictions(spark, path, 2).where("realized_error is null").count() == 2


def test_the_rmse_alert_counts_from_realization(spark):
    rows = [("A", START + timedelta(seconds=at), START + timedelta(seconds=at + 1000), 0.05) for at in (0, 400)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, realized_at timestamp, realized_return_error double")
    assert monitor.rmse_alerts(df).first()["pending_since"] == START + timedelta(seconds=1020)
