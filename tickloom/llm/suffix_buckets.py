"""Removal of byte strings that occur twice, by bucket-pointer refinement over the corpus.

Every position begins a suffix. Suffixes are put into buckets by their first 8 bytes, and a bucket is refined by sorting
on the bucket identifiers at a later offset: the identifiers for 8 bytes give those for 16, these the ones for 32 and so
on, each refinement reusing what the last one updated, until buckets stand for 200 bytes. An identifier is a 64-bit value
mixed from the two it refines, so that equal strings have equal identifiers wherever they are computed, and only the
sorting that tells single suffixes from shared ones goes through a shuffle. Positions leave as soon as they are single:

1. At 96 bytes only *anchors* are sorted, positions whose identifier is smallest among 105 in a row. A string of 200 bytes
   has 105 positions of 96 bytes; the smallest is an anchor wherever the string stands, so it is in a shared bucket if
   the string occurs twice.
2. At 216 bytes those positions are sorted that are smallest among 17 in a row and whose 216 bytes may still be shared.
   A shared bucket settles all 17 strings of 200 bytes within.
3. At 200 bytes the positions are sorted that neither step has settled, those near the ends of shared passages, and with
   them the settled ones of the first member of each bucket of step 2, which stand for the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import kept
from tickloom.llm.text import only, slices

LENGTH, GRAM, DEEP = 200, 96, 216
ROW = LENGTH - GRAM + 1  # places of a gram in a string
STEP = DEEP - LENGTH + 1  # places of a string in a deep one
_U = np.uint64
_LEFT, _RIGHT = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


def first_buckets(raw: np.ndarray) -> np.ndarray:
    """The bucket of every suffix of at least 8 bytes: these bytes as a number."""
    x = raw.astype(_U)
    for width, bits in ((1, 8), (2, 16), (4, 32)):
        x = x[: max(len(x) - width, 0)] | (x[width:] << _U(bits))
    return x


def refined(buckets: np.ndarray, offset: int) -> np.ndarray:
    """Buckets by what they were and by the bucket at a later offset."""
    n = max(len(buckets) - offset, 0)
    return _mix(buckets[:n] * _LEFT + buckets[offset:] * _RIGHT)


def buckets_at(raw: np.ndarray, depths: tuple[int, ...]) -> list[np.ndarray]:
    """Bucket identifiers at the given depths, each from the one before: 8, 16, 32 ... and what lies between."""
    have, depth, out = first_buckets(raw), 8, []
    for wanted in depths:
        while depth < wanted:
            step = min(depth, wanted - depth)
            have, depth = refined(have, step), depth + step
        out.append(have)
    return out


def _sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The minimum (or maximum) of every ``width`` values in a row."""
    pick = np.minimum if least else np.maximum
    n = len(x) - width + 1
    fill = np.full(-len(x) % width, np.iinfo(np.uint64).max if least else 0, _U)
    blocks = np.concatenate((x, fill)).reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    back = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(grams: np.ndarray, row: int = ROW) -> np.ndarray:
    """Positions whose bucket is the smallest of some ``row`` buckets in a row."""
    if len(grams) < row:
        return np.zeros(0, np.int64)
    return _attained(grams, _sliding(grams, row, True), row)


def _attained(grams: np.ndarray, least: np.ndarray, row: int) -> np.ndarray:
    edge = np.zeros(row - 1, _U)
    return np.flatnonzero(_sliding(np.concatenate((edge, least, edge)), row, False) == grams)


def _rows(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate([np.asarray(a) for a in arrays]) if arrays else np.zeros(0, np.int64)
    values = values.view(np.int64) if values.dtype == _U else values.astype(kind.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _texts(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint8) for x in batch.column("text").cast(pa.binary()).to_pylist()]


def _numbers(column: pa.Array) -> list[np.ndarray]:
    """A list column as arrays, empty where it is null."""
    return [np.zeros(0, np.int64) if x.values is None else x.values.to_numpy(zero_copy_only=False) for x in column]


def inside(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in [s, s + width) for one of the starts."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, np.clip(starts, 0, n), 1)
    np.add.at(edge, np.clip(starts + width, 0, n), -1)
    return np.cumsum(edge[:n]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and ends of the runs of true values."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def open_strings(raw: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """After step 1: which strings may occur twice, and the positions and deep buckets that step 2 sorts."""
    grams, deep = buckets_at(raw, (GRAM, DEEP))
    least = _sliding(grams, ROW, True)  # of each string, the bucket of its anchor
    change = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    free = np.repeat(np.isin(least[change], grams[shared]), np.diff(np.append(change, len(least))))
    blocked = np.concatenate(([0], np.cumsum(~free)))
    at = anchors(grams, STEP) if free.any() else np.zeros(0, np.int64)
    at = at[at < len(deep)]
    at = at[blocked[at + STEP] == blocked[at]]
    return free, at, deep[at]


def _shared(rows: DataFrame) -> DataFrame:
    """``t, pos, leads``: the rows of ``h, t, pos`` whose bucket ``h`` another row has too, and which is the first of it.

    Equal rows, which copies of a text give, count once. One pass over sorted rows, in constant memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, held_shared = ("h", "t", "pos"), None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            h, t, pos = (batch.column(c).to_numpy() for c in names)
            if held is not None:
                h, t, pos = (np.concatenate((a, b)) for a, b in zip(held, (h, t, pos)))
            fresh = np.concatenate(([True], (h[1:] != h[:-1]) | (t[1:] != t[:-1]) | (pos[1:] != pos[:-1])))
            h, t, pos = h[fresh], t[fresh], pos[fresh]
            equal = h[1:] == h[:-1]
            after = np.concatenate(([held_shared], equal))  # an earlier row has the bucket
            shared = after | np.concatenate((equal, [False]))
            held, held_shared = (h[-1:], t[-1:], pos[-1:]), bool(after[-1])
            keep = shared[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(t[:-1][keep]), pa.array(pos[:-1][keep]), pa.array(~after[:-1][keep])], names=["t", "pos", "leads"])
        if held is not None and held_shared:
            yield pa.RecordBatch.from_arrays([pa.array(held[1]), pa.array(held[2]), pa.array([False])], names=["t", "pos", "leads"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "h").sortWithinPartitions("h", "t", "pos").mapInArrow(run, "t long, pos int, leads boolean")


def _per_text(rows: DataFrame, name: str) -> DataFrame:
    leads = F.collect_list(F.when(F.col("leads"), F.col("pos"))).alias("leads")
    return rows.groupBy("t").agg(F.collect_list("pos").alias(name), leads)


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """``h, t, pos`` of step 1. A task takes a text once; what it meets again is a copy and known as such."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in slices(batches, "text"):
            keys, h, at = [], [], []
            for t, raw in zip(batch.column("t").to_pylist(), _texts(batch)):
                if t in met or len(raw) < LENGTH:
                    continue
                met.add(t)
                (grams,) = buckets_at(raw, (GRAM,))
                keys.append(t), at.append(anchors(grams)), h.append(grams[at[-1]])
            if len(met) > 1_000_000:
                met.clear()
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), _rows(h, pa.int64()), _rows(at, pa.int32())], names=["t", "h", "pos"])

    found = docs.select("t", "text").mapInArrow(run, "t long, h array<long>, pos array<int>")
    return found.select("t", F.explode_outer(F.arrays_zip("h", "pos")).alias("x")).select("x.h", "t", "x.pos").where("h is not null")


def _deep_rows(docs: DataFrame) -> DataFrame:
    """``t, first, last, pos, h``: runs of open strings and the rows of step 2, for ``t, text, shared``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [open_strings(raw, shared) for raw, shared in zip(_texts(batch), _numbers(batch.column("shared")))]
            spans = [runs(free) for free, _, _ in found]
            columns = [_rows([s[0] for s in spans], pa.int32()), _rows([s[1] for s in spans], pa.int32()), _rows([x[1] for x in found], pa.int32()), _rows([x[2] for x in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("t"), *columns], names=["t", "first", "last", "pos", "h"])

    return docs.mapInArrow(run, "t long, first array<int>, last array<int>, pos array<int>, h array<long>")


def _left_rows(docs: DataFrame) -> DataFrame:
    """``h, t, pos`` of step 3, for ``t, text, first, last, deep, leads``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            h, at = [], []
            for raw, first, last, deep, leads in zip(_texts(batch), *(_numbers(batch.column(c)) for c in ("first", "last", "deep", "leads"))):
                n = len(raw) - LENGTH + 1
                free = np.zeros(n, bool)
                for a, b in zip(first.tolist(), last.tolist()):
                    free[a:b] = True
                free = free & ~inside(deep, STEP, n) | inside(leads, STEP, n)
                parts = [(a, buckets_at(raw[a : b + LENGTH - 1], (LENGTH,))[0]) for a, b in zip(*(x.tolist() for x in runs(free)))]
                h.append(np.concatenate([x for _, x in parts]) if parts else np.zeros(0, _U))
                at.append(np.flatnonzero(free))
            yield pa.RecordBatch.from_arrays([batch.column("t"), _rows(h, pa.int64()), _rows(at, pa.int32())], names=["t", "h", "pos"])

    found = docs.mapInArrow(run, "t long, h array<long>, pos array<int>")
    return found.select("t", F.explode_outer(F.arrays_zip("h", "pos")).alias("x")).select("x.h", "t", "x.pos").where("h is not null")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept`` (binary, the bytes that stay).

    A byte goes if a string of LENGTH bytes that covers it also begins anywhere else in the table. A null or empty text
    has no bytes; rows that repeat a text remove each other whole, if it is long enough, whatever their identifiers,
    which may be null or repeated; an empty table gives an empty one; other columns are not looked at.
    """
    rows = only(docs, id_col, text_col).withColumn("t", F.xxhash64("text"))
    size = F.octet_length("text")
    texts = kept(rows.where(size >= LENGTH).groupBy("t").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")))
    anchored = kept(_per_text(_shared(_anchor_rows(rows)), "shared"))
    # One row of each text stands for all of them; further rows with its identifier are copies and change nothing.
    one = lambda by: rows.join(by.join(texts, "t"), "t").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    opened = kept(_deep_rows(one(anchored).select("t", "text", "shared")).where(F.size("first") > 0))
    deep_rows = opened.select("t", F.explode(F.arrays_zip("h", "pos")).alias("x")).select("x.h", "t", "x.pos")
    deep = kept(_per_text(_shared(deep_rows), "deep"))
    runs_left = opened.select("t", "first", "last").join(deep, "t", "left")
    left = kept(_per_text(_shared(_left_rows(one(runs_left).select("t", "text", "first", "last", "deep", "leads"))), "strings"))
    found = deep.drop("leads").join(left.drop("leads"), "t", "full").join(texts.where("copies > 1").select("t", F.lit(True).alias("copied")), "t", "full")
    found = kept(found)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for raw, deep, strings, copied in zip(_texts(batch), *(_numbers(batch.column(c)) for c in ("deep", "strings")), batch.column("copied").to_pylist()):
                gone = inside(deep, DEEP, len(raw)) | inside(strings, LENGTH, len(raw)) | (bool(copied) and len(raw) >= LENGTH)
                out.append((len(raw), int(gone.sum()), len(runs(gone)[0]), raw[~gone].tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    touched = rows.join(found, "t", "left")
    return touched.select("doc_id", "text", "deep", "strings", "copied").mapInArrow(run, schema)
