"""Predictions realized on streams against the batch forms."""

from __future__ import annotations

import os
import random
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import START, predictions as table
from tickloom.operators import predictions as p
from tickloom.schemas import PREDICTION
from tickloom.streaming import sinks
from tickloom.streaming.realize import stream_realize_asof, stream_realize_fifo

PRICES = "symbol string, event_ts timestamp, price double, key string"


def prices(spark, rows):
    return spark.createDataFrame([(s, START + timedelta(seconds=at), float(v), k) for s, at, v, k in rows], PRICES)


def stream(spark, folder, frames, schema):
    for i, df in enumerate(frames):
        before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
        df.coalesce(1).write.mode("append").parquet(folder)
        stamp = time.time() - 1000 + i
        for name in set(os.listdir(folder)) - before:
            os.utime(os.path.join(folder, name), (stamp, stamp))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def day(rnd, n=90):
    asked = [(i, rnd.choice("AB"), rnd.randrange(300), 100, 100 + rnd.random(), 0.01 * rnd.random()) for i in range(n)]
    seen = [(rnd.choice("AB"), rnd.randrange(300), 95 + 10 * rnd.random(), f"k{i:03d}") for i in range(n)]
    return asked, seen


def parted(rnd, rows, at, parts):
    """Rows by arrival, up to 25 seconds late, in so many parts of equal time."""
    arrival = [(row[at] + rnd.uniform(0, 25), row) for row in rows]
    return [[row for when, row in arrival if k * 330 / parts <= when < (k + 1) * 330 / parts] for k in range(parts)]


@pytest.mark.parametrize("way, parts", [("fifo", 1), ("fifo", 5), ("asof", 1), ("asof", 5), ("horizon", 4)])
def test_stream_equals_batch(spark, tmp_path, way, parts):
    rnd = random.Random(f"{way}{parts}")
    asked, seen = day(rnd)
    closing = [(900 + i, s, 9_000, 100, 100, 0.0) for i, s in enumerate("AB")]
    asks = stream(spark, str(tmp_path / "asks"), [table(spark, x) for x in [*parted(rnd, asked, 2, parts), closing]], PREDICTION)
    ticks = stream(spark, str(tmp_path / "ticks"), [prices(spark, x) for x in [*parted(rnd, seen, 1, parts), []]], PRICES)
    # An hour of delay within the triggers of a test: both streams advance by one file at a time.
    make = {
        "fifo": lambda: stream_realize_fifo(asks, ticks, "120 seconds", ["key"]),
        "asof": lambda: stream_realize_asof(asks, ticks, "120 seconds", "0 seconds", ["key"]),
        "horizon": lambda: stream_realize_asof(asks, ticks, "120 seconds", "30 seconds", ["key"]),
    }[way]
    made = make()
    sinks.run_stream(made, str(tmp_path / "out"), available_now=True).awaitTermination()
    got = spark.read.schema(made.schema).parquet(str(tmp_path / "out"))
    batch = {
        "fifo": lambda a, b: p.realize_fifo(a, b, ["key"]),
        "asof": lambda a, b: p.realize_asof(a, b, "0 seconds", ["key"]),
        "horizon": lambda a, b: p.realize_asof(a, b, "30 seconds", ["key"]),
    }[way](table(spark, asked), prices(spark, seen)).where("realized_error is not null")

    def plain(df):
        return sorted((r["id"], r["realized_at"], round(r["realized_error"], 9), round(r["realized_return_error"], 9)) for r in df.collect())

    assert plain(got) == plain(batch) and len(plain(got)) > 30


def test_predictions_that_wait_too_long_are_given_up(spark, tmp_path):
    asked = [[(1, "A", 0, 100, 101, 0.0)], [(2, "A", 5_000, 100, 101, 0.0)], [(3, "A", 9_000, 100, 101, 0.0)], [(4, "A", 20_000, 1, 1, 0.0)]]
    seen = [[], [], [("A", 9_500, 102, "k")], []]
    asks = stream(spark, str(tmp_path / "asks"), [table(spark, x) for x in asked], PREDICTION)
    ticks = stream(spark, str(tmp_path / "ticks"), [prices(spark, x) for x in seen], PRICES)
    made = stream_realize_fifo(asks, ticks, "10 seconds", give_up="1 hour")
    sinks.run_stream(made, str(tmp_path / "out"), available_now=True).awaitTermination()
    assert [r["id"] for r in spark.read.schema(made.schema).parquet(str(tmp_path / "out")).select(F.col("id")).collect()] == [3]
