from __future__ import annotations

import os
from datetime import date
from pathlib import Path

import pytest

from helpers import ticks
from tickloom.operators.ingest import validate_events
from tickloom.operators.features import tick_features
from tickloom.sources import lake

DAY = date(2026, 8, 1)


def four_rows(spark):
    return validate_events(ticks(spark, [("BTCUSDT", 100, 10, 0), ("BTCUSDT", 102, 8, 1), ("ETHUSDT", 50, 5, 0), ("ETHUSDT", 51, 6, 1)]))


def test_write_read_and_prune(spark, tmp_path):
    base = str(tmp_path / "raw")
    lake.write_raw_batch(four_rows(spark), base)
    assert (tmp_path / "raw" / "year=2026" / "month=8" / "day=1" / "symbol=BTCUSDT").is_dir()
    df = lake.read_lake(spark, base)
    assert df.count() == 4 and set(df.columns) >= {"symbol", "price", "year", "month", "day"}
    one = lake.read_partition(spark, base, DAY, "ETHUSDT")
    assert sorted(r["price"] for r in one.collect()) == [50.0, 51.0]
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "symbol" in filters and "year" in filters
    assert lake.read_lake(spark, base).where(lake.between_dates(date(2026, 8, 1), date(2026, 8, 2))).count() == 4
    assert lake.read_lake(spark, base).where(lake.between_dates(date(2026, 8, 2), date(2027, 1, 2))).count() == 0


def test_symbols_stay_text(spark, tmp_path):
    base = str(tmp_path / "raw")
    lake.write_raw_batch(validate_events(ticks(spark, [("007", 1, 1, 0)])), base)
    assert lake.read_lake(spark, base).first()["symbol"] == "007"


def test_date_parts_from_text(spark):
    df = ticks(spark, [("A", 1, 1, 0)])
    assert tuple(lake.with_date_partitions(df).select("year", "month", "day").first()) == (2026, 8, 1)


def test_features_lake(spark, tmp_path):
    base = str(tmp_path / "features")
    lake.write_features_batch(tick_features(four_rows(spark)), base)
    assert lake.read_partition(spark, base, DAY, "BTCUSDT").count() == 2


def files(base, symbol):
    folder = Path(base) / "year=2026" / "month=8" / "day=1" / f"symbol={symbol}"
    return [f for f in os.listdir(folder) if f.endswith(".parquet")]


def test_compaction(spark, tmp_path):
    base = str(tmp_path / "raw")
    for _ in range(2):
        lake.write_raw_batch(four_rows(spark), base)
    assert len(files(base, "BTCUSDT")) == 2
    assert lake.compact_partition(spark, base, DAY, "BTCUSDT") == 4
    assert len(files(base, "BTCUSDT")) == 1 and len(files(base, "ETHUSDT")) == 2
    assert lake.read_lake(spark, base).count() == 8
    assert not any((tmp_path / "raw_compaction").iterdir())
    with pytest.raises(Exception):
        lake.compact_partition(spark, base, DAY, "NONE")


def test_retention(spark, tmp_path):
    old, new = tmp_path / "year=2026" / "month=4" / "day=23", tmp_path / "year=2026" / "month=7" / "day=31"
    for folder in (old, new, tmp_path / "notes", tmp_path / "year=x", tmp_path / "year=2026" / "month=2" / "day=31"):
        folder.mkdir(parents=True)
    args = (spark, str(tmp_path), 90, date(2026, 8, 1))
    assert [Path(p).name for p in lake.apply_retention(*args, dry_run=True)] == ["day=23"] and old.exists()
    lake.apply_retention(*args)
    assert not old.exists() and new.exists() and (tmp_path / "notes").exists()
    assert lake.apply_retention(spark, str(tmp_path / "missing")) == []


def test_retention_is_strict(spark, tmp_path):
    (tmp_path / "year=2026" / "month=5" / "day=3").mkdir(parents=True)  # exactly 90 days before
    assert lake.apply_retention(spark, str(tmp_path), 90, date(2026, 8, 1)) == []


def test_reference_may_be_missing(spark, tmp_path):
    assert lake.read_reference(spark, str(tmp_path / "none")) is None


def test_compaction_of_a_symbol_with_a_slash(spark, tmp_path):
    base = str(tmp_path / "raw")
    rows = validate_events(ticks(spark, [("BTC/USDT", 1, 1, 0), ("BTC", 1, 1, 0)]))
    for _ in range(3):
        lake.write_raw_batch(rows, base)
    assert lake.compact_partition(spark, base, DAY, "BTC/USDT") == 3 and lake.read_lake(spark, base).count() == 6


def test_half_done_compaction_is_repaired(spark, tmp_path):
    base = str(tmp_path / "raw")
    lake.write_raw_batch(four_rows(spark), base)
    where = "year=2026/month=8/day=1/symbol=ETHUSDT"
    old = tmp_path / "raw_compaction" / "20260801" / "old" / where
    old.parent.mkdir(parents=True)
    (tmp_path / "raw" / where).rename(old)
    assert lake.read_lake(spark, base).count() == 2
    assert lake.recover_compaction(spark, base) == [f"{base}/{where}"] and lake.read_lake(spark, base).count() == 4


def test_a_batch_is_stored_once(spark, tmp_path):
    base, batches = str(tmp_path / "raw"), str(tmp_path / "batches")
    lake.append_batch(four_rows(spark), base, batches, 0)
    lake.append_batch(four_rows(spark), base, batches, 0)
    (tmp_path / "batches" / "0.done").unlink()  # as if it had crashed before its end
    lake.append_batch(four_rows(spark), base, batches, 0)
    lake.append_batch(four_rows(spark), base, batches, 1)
    assert lake.read_lake(spark, base).count() == 8


def test_stream_batch_compaction_and_retention_share_a_lake(spark, tmp_path):
    from tickloom.streaming import sinks

    base, source, checkpoint = (str(tmp_path / n) for n in ("raw", "in", "c"))

    def stream_on(rows):
        rows.write.mode("append").parquet(source)
        events = spark.readStream.schema(rows.schema).parquet(source)
        sinks.write_raw_stream(events, base, checkpoint, available_now=True).awaitTermination()
        return lake.read_lake(spark, base).count()

    rows = four_rows(spark)
    assert stream_on(rows) == 4
    lake.write_raw_batch(rows, base)
    assert lake.read_lake(spark, base).count() == 8
    assert lake.compact_partition(spark, base, DAY, "BTCUSDT") == 4 and lake.read_lake(spark, base).count() == 8
    assert stream_on(rows) == 12
    assert len(lake.apply_retention(spark, base, 90, date(2027, 1, 1))) == 1
    assert stream_on(rows) == 4
