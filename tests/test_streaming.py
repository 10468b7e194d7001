from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import predictions, ticks
from test_features import random_ticks
from tickloom.operators import features, ingest, time_windows
from tickloom.schemas import MARKET_EVENT, TICK_FEATURES
from tickloom.sources import lake
from tickloom.sources import ticks as sources
from tickloom.streaming import sinks
from tickloom.streaming.accuracy import show_running_accuracy
from tickloom.streaming.features import stream_ordered_tick_features, stream_tick_features, stream_time_window_features


def replay(spark, folder, parts, files_per_trigger=1):
    """A stream that reads each part in a trigger of its own."""
    for i, part in enumerate(parts):
        ticks(spark, part).coalesce(1).write.mode("append").parquet(folder)
        # Files are read in order of their modification time.
        import os
        import time

        stamp = time.time() - 1000 + i
        for name in os.listdir(folder):
            path = os.path.join(folder, name)
            if os.path.getmtime(path) > time.time() - 500:
                os.utime(path, (stamp, stamp))
    return spark.readStream.schema(MARKET_EVENT).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def run(df, path):
    query = sinks.run_stream(df, path, available_now=True)
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


@pytest.mark.parametrize("sizes", [[300], [1, 2, 100, 197], [75] * 4])
def test_stream_equals_batch(spark, tmp_path, sizes):
    rows = random_ticks()
    parts, start = [], 0
    for size in sizes:
        part = rows[start : start + size]
        random.Random(size).shuffle(part)  # order inside a trigger must not matter
        parts.append(part)
        start += size
    streamed = run(stream_tick_features(replay(spark, str(tmp_path / "in"), parts)), str(tmp_path / "out"))
    batch = features.compute_features(ticks(spark, rows), "batch")
    assert streamed.columns == TICK_FEATURES
    got, want = ({(r["symbol"], r["event_ts"]): r for r in df.collect()} for df in (streamed, batch))
    assert got.keys() == want.keys() and len(want) == 300
    for key, row in want.items():
        for c in TICK_FEATURES[2:]:
            assert got[key][c] == (None if row[c] is None else pytest.approx(row[c], abs=1e-9)), (key, c)


def test_late_tick_is_appended_or_dropped(spark, tmp_path):
    parts = [[("A", 100, 1, 0), ("A", 110, 1, 100)], [("A", 120, 1, 200)], [("A", 50, 1, 10)], [("A", 60, 1, 201)]]
    kept = run(stream_tick_features(replay(spark, str(tmp_path / "in"), parts)), str(tmp_path / "out"))
    assert {r["price"]: r["price_change"] for r in kept.collect()} == {100: None, 110: 10, 120: 10, 50: -70, 60: 10}
    dropped = run(stream_tick_features(replay(spark, str(tmp_path / "in2"), parts), late_after="10 seconds"), str(tmp_path / "out2"))
    assert {r["price"]: r["price_change"] for r in dropped.collect()} == {100: None, 110: 10, 120: 10, 60: -60}


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_ticks_in_any_order_within_the_delay(spark, tmp_path, parts):
    rnd = random.Random(parts)
    rows = [(rnd.choice("ABC"), 100 + rnd.randrange(40), 1 + rnd.randrange(5), i // 2, f"k{i:03d}") for i in range(240)]
    arrival = sorted(rows, key=lambda r: r[3] + rnd.uniform(0, 29))  # up to 29 seconds late
    size = -(-len(arrival) // parts)
    closing = [[("A", 1, 1, 9_000, "x"), ("B", 1, 1, 9_000, "y"), ("C", 1, 1, 9_000, "z")]]
    stream = replay(spark, str(tmp_path / "in"), [arrival[i : i + size] for i in range(0, len(arrival), size)] + closing)
    out = run(stream_ordered_tick_features(stream, "30 seconds"), str(tmp_path / "out")).collect()
    want = features.compute_features(ticks(spark, rows), "batch").collect()

    def plain(found):
        return sorted([r["symbol"], str(r["event_ts"]), *(None if r[c] is None else round(r[c], 9) for c in TICK_FEATURES[2:])] for r in found)

    got, expected = plain(out), plain(want)
    assert [[repr(x) for x in r] for r in got] == [[repr(x) for x in r] for r in expected] and len(got) == 240


def test_ticks_later_than_the_delay_are_dropped(spark, tmp_path):
    parts = [[("A", 100, 1, 0), ("A", 110, 1, 100)], [("A", 120, 1, 200), ("A", 115, 1, 150)], [("A", 50, 1, 10), ("A", 130, 1, 195)], [("A", 1, 1, 9_000)]]
    out = run(stream_ordered_tick_features(replay(spark, str(tmp_path / "in"), parts), "60 seconds"), str(tmp_path / "out")).collect()
    assert {r["price"]: r["price_change"] for r in out} == {100: None, 110: 10, 115: 5, 130: 15, 120: -10}


def test_state_with_a_lifetime(spark, tmp_path):
    df = stream_tick_features(replay(spark, str(tmp_path / "in"), [[("A", 1, 1, 0)], [("A", 2, 1, 1)]]), ttl_ms=3_600_000)
    query = df.writeStream.format("memory").queryName("aging").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        for _ in range(30):  # with a lifetime the query keeps running to check it
            query.awaitTermination(1)
            if spark.table("aging").count() == 2:
                break
        assert sorted((r["price"], r["price_change"]) for r in spark.table("aging").collect()) == [(1.0, None), (2.0, 1.0)]
    finally:
        query.stop()


def test_time_windows_in_a_stream(spark, tmp_path):
    rows = [("A", 100 + i % 7, 1 + i % 3, 20 * i) for i in range(120)]
    closing = [("A", 1, 1, 100_000)]
    stream = stream_time_window_features(replay(spark, str(tmp_path / "in"), [rows[:60], rows[60:], closing]))
    out = run(stream, str(tmp_path / "out")).collect()
    want = {r["window"]["start"]: r for r in time_windows.time_window_features(ticks(spark, rows)).collect()}
    assert len(out) >= 35
    for r in out:
        mine, other = r.asDict(), want[r["window"]["start"]].asDict()
        assert all(mine[c] == pytest.approx(other[c]) for c in mine if c not in ("window", "symbol")), (mine, other)


def test_time_windows_of_several_symbols_keep_few_rows(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(rnd.choice("AB"), 100 + rnd.randrange(50), 1 + rnd.randrange(3), 2 * i + rnd.randrange(2)) for i in range(900)]
    late = rows[400:420]  # within the watermark
    parts = [rows[:400] + rows[420:430], late + rows[430:600], rows[600:], [("A", 1, 1, 100_000), ("B", 1, 1, 100_000)], [("A", 1, 1, 200_000)]]
    stream = stream_time_window_features(replay(spark, str(tmp_path / "in"), parts), duration="30 seconds")
    query = sinks.run_stream(stream, str(tmp_path / "out"), available_now=True)
    query.awaitTermination()
    out = spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).where("window.end < timestamp'2026-08-01 12:00:00'").collect()
    want = {(r["symbol"], r["window"]["start"]): r for r in time_windows.time_window_features(ticks(spark, rows), "30 seconds").collect()}
    assert {(r["symbol"], r["window"]["start"]) for r in out} == want.keys()
    for r in out:
        mine, other = r.asDict(), want[r["symbol"], r["window"]["start"]].asDict()
        assert all(mine[c] == pytest.approx(other[c]) for c in mine if c not in ("window", "symbol")), (mine, other)
    # Copies follow the bars, at most 40 windows of 30 seconds for each, and not the ticks.
    held = max(sum(op["numRowsTotal"] for op in progress["stateOperators"]) for progress in query.recentProgress)
    assert held <= 2 * (30 + 45) + 2 * 60 + 2 * 45


def test_stream_dedup(spark, tmp_path):
    df = replay(spark, str(tmp_path / "in"), [[("A", 1, 1, 0, "k1"), ("A", 1, 1, 1, "k1")], [("A", 1, 1, 2, "k1"), ("A", 1, 1, 3, "k2")]])
    out = run(ingest.dedup_stream(ingest.validate_events(df)), str(tmp_path / "out"))
    assert sorted(r["idempotency_key"] for r in out.collect()) == ["k1", "k2"]


def test_json_files_to_lake(spark, tmp_path):
    ticks(spark, [("A", 1, 1, 0), ("B", 2, 1, 0)]).select(F.to_json(F.struct("*"))).write.text(str(tmp_path / "in"))
    events = ingest.validate_events(sources.json_file_ticks(spark, str(tmp_path / "in")))
    query = sinks.write_raw_stream(events, str(tmp_path / "lake"), str(tmp_path / "ckpt"), available_now=True)
    query.awaitTermination()
    assert lake.read_lake(spark, str(tmp_path / "lake")).count() == 2
    assert (tmp_path / "lake" / "year=2026" / "month=8" / "day=1" / "symbol=A").is_dir()


def test_generated_ticks_and_memory_table(spark, tmp_path):
    df = stream_tick_features(sources.generated_ticks(spark, 50))
    assert df.isStreaming and df.columns == TICK_FEATURES
    query = df.writeStream.format("memory").queryName("made").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        query.awaitTermination(5)  # the source never ends
        assert query.exception() is None and spark.table("made").columns == TICK_FEATURES
    finally:
        query.stop()


def test_kafka_source_is_wired(spark):
    """Without the connector Spark names the missing source; nothing else may go wrong before that."""
    with pytest.raises(Exception, match="(?i)kafka"):
        sources.kafka_ticks(spark, "localhost:9092", "ticks")


def test_running_accuracy(spark, tmp_path):
    stored = predictions(spark, [(1, "A", 0, 100, 101, 0.01, 3.0, 0.01), (2, "A", 1, 100, 101, 0.01, -4.0, -0.03)])
    stored.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(stored.schema).parquet(str(tmp_path / "in"))
    query = show_running_accuracy(stream, "accuracy_now", str(tmp_path / "c"))
    try:
        query.processAllAvailable()
        row = spark.table("accuracy_now").first()
        assert row["mae"] == 3.5 and row["directional_accuracy"] == 0.5
    finally:
        query.stop()


def test_compute_features_chooses_the_stream(spark, tmp_path):
    df = features.compute_features(replay(spark, str(tmp_path / "in"), [[("A", 1, 1, 0)]]))
    assert df.isStreaming


def test_messages_go_to_the_lake_or_to_the_dead_letters(spark, tmp_path):
    good = '{"symbol":"A","price":%d,"volume":1.0,"timestamp":"2026-08-01T00:00:%02d","source":"x","idempotency_key":"%d"}'
    messages = [good % (100 + i, i, i) for i in range(20)] + ["", "{", '{"symbol":"A"}', good % (-1, 1, 77), "é not json", None]
    folder = str(tmp_path / "messages")
    for part in (messages[:13], messages[13:]):
        spark.createDataFrame([(m,) for m in part], "value string").coalesce(1).write.mode("append").parquet(folder)
    base, dead, checkpoint = (str(tmp_path / name) for name in ("lake", "dead", "checkpoint"))

    def run_all():
        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(folder)
        sinks.write_decoded_stream(ingest.decode_events(stream), base, dead, checkpoint, available_now=True).awaitTermination()

    def content():
        events = sorted(r["price"] for r in lake.read_lake(spark, base).collect())
        return events, sorted((r["payload"] or "-", r["reject_reason"]) for r in spark.read.parquet(dead).collect())

    run_all()
    events, letters = content()
    assert events == [100.0 + i for i in range(20)]
    assert [reason for _, reason in letters] == [reason for _, reason in sorted([
        ("", "not a JSON object"), ("{", "not a JSON object"), ('{"symbol":"A"}', "missing fields"),
        (good % (-1, 1, 77), "price or volume out of range"), ("é not json", "not a JSON object"), ("-", "not a JSON object"),
    ])]
    # The last batch is tried again, as after a crash before it was noted as done.
    commits = tmp_path / "checkpoint" / "commits"
    newest = max((f for f in commits.iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
    newest.unlink(), (commits / f".{newest.name}.crc").unlink(missing_ok=True)
    run_all()
    assert content() == (events, letters)
