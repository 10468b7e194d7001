"""Importance resampling towards a target corpus, by hashed features, with exact cut-offs.

Features of a text are all runs of 1 to ``most`` consecutive words, hashed into buckets. The gain of a bucket compares how
often the target's and the source's features fall into it; a document's weight is the floored mean of its features' gains.
Gumbel noise that depends on the identifier alone is added, so that the highest scores are a draw without replacement in
proportion to the exponential of the weights, and the same one in every run.

1. Each task counts its features in one array; the sums are one number for each bucket.
2. The gains, an array with one number for each bucket, score all documents; scores are stored.
3. The lowest drawn score is found by bisection: jobs that count the stored scores from some thresholds on, until one
   is left, then the same over the identifiers among the documents tied at it. Nothing is sorted for it.
4. The drawn rows are range-partitioned by score and identifier; a row's rank is its place in its partition and the rows of
   the partitions before. Equal rows may be cut apart, so that one identifier that holds many rows is no hot spot.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.store import kept
from tickloom.llm.text import only, slices

PROBES = 7  # thresholds that one counting job tries: three halvings
_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_CAPITALS = bytes(range(0x41, 0x5B))
#: A-Z in lower case; what belongs to no word becomes a blank. Characters beyond ASCII consist of bytes from 0x80 on.
_WORD_BYTES = bytes(b if b in _KEEP else b + 32 if b in _CAPITALS else 0x20 for b in range(256))
_MOST_CACHED = 1 << 20


class Buckets(dict):
    """Feature to bucket; forgets what it holds when that becomes too much."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _MOST_CACHED:
            self.clear()
        self[feature] = found = zlib.crc32(feature) % self.n
        return found


def feature_buckets(text: bytes, most: int, buckets: Buckets) -> tuple[list[int], int]:
    """The bucket of every feature of a text, and the number of its words."""
    words = text.translate(_WORD_BYTES).split()
    found = list(map(buckets.__getitem__, words))
    for n in range(2, most + 1):
        found += [buckets[b" ".join(words[i : i + n])] for i in range(len(words) - n + 1)]
    return found, len(words)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def bucket_counts(docs: DataFrame, most: int, n_buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket; ``docs`` has a ``text`` without nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, buckets = np.zeros(n_buckets, np.int64), Buckets(n_buckets)
        for batch in slices(batches, "text"):
            for text in _texts(batch):
                counts += np.bincount(np.array(feature_buckets(text, most, buckets)[0], np.int64), minlength=n_buckets)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], names=["bucket", "n"])

    found = np.zeros(n_buckets, np.int64)
    sums = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in sums.collect():  # n_buckets rows at most
        found[row["bucket"]] = row["n"]
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket: a thousand times the logarithm of the smoothed ratio of shares, floored."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratios = (((t + 1) * (s_all + n)) / ((s + 1) * (t_all + n)) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, most: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` for every row; ``docs`` has ``doc_id`` and a ``text`` without nulls."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(len(gain))
        for batch in slices(batches, "text"):
            n_words, n_features, weight = [], [], []
            for text in _texts(batch):
                found, words = feature_buckets(text, most, buckets)
                n_words.append(words)
                n_features.append(len(found))
                weight.append(int(gain[found].sum()) // len(found) if found else 0)
            columns = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    return docs.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(seed: int) -> Column:
    """Gumbel noise in thousandths, from the identifier's text alone."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(head, 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def highest_bound(rows: DataFrame, value: Column, wanted: int) -> int:
    """The largest number that ``wanted`` or more values reach; there are at least so many."""
    rows = rows.select(value.alias("v"))
    low, high = rows.agg(F.min("v"), F.max("v")).first()
    while low < high:
        step = range(1, PROBES + 1)
        probes = sorted({low + -(-(high - low) * i // (PROBES + 1)) for i in step})
        counts = rows.agg(*(F.count_if(F.col("v") >= F.lit(p)).alias(f"n{i}") for i, p in enumerate(probes))).first()
        reached = sum(n >= wanted for n in counts)
        if reached < len(probes):
            high = probes[reached] - 1
        if reached:
            low = probes[reached - 1]
    return low


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    most: int = 1,
    n_buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_features, weight, score, rank`` (all but ``doc_id`` long).

    ``target`` has texts under the same name. Of the rows with ``least_words`` words or more, ``percent`` hundredths are
    drawn (floored): the highest scores, ties to the smaller identifier. ``rank`` counts them from 1 and is null elsewhere.
    Identifiers are whole numbers; a null one counts as larger than all others, and as an empty text in the noise. Rows that
    repeat an identifier are drawn each by itself; ties among them go to the smaller number of features and weight, and
    equal rows get ranks in any order. Null and empty texts have no features and weight 0, texts of any length count whole,
    an empty target counts nothing, an empty table gives an empty one. Names of other columns do not matter.
    """
    rows = only(docs, id_col, text_col)
    wanted_texts = only(target.withColumn("_none", F.lit(None).cast("long")), "_none", text_col)
    gain = gains(bucket_counts(rows, most, n_buckets), bucket_counts(wanted_texts, most, n_buckets))
    scored = weights(rows, gain, most).withColumn("score", F.col("weight") + noise(seed))
    scored = kept(scored.withColumn("row", F.monotonically_increasing_id()))

    fit = scored.where(F.col("n_words") >= least_words)
    n_drawn = fit.count() * percent // 100
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    if not n_drawn:
        return scored.select(*names, F.lit(None).cast("long").alias("rank"))
    # Complements turn the order of identifiers round without an overflow.
    turned = F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(-(1 << 63)))
    lowest = highest_bound(fit, F.col("score"), n_drawn)
    above = fit.where(F.col("score") > lowest).count()
    tied = highest_bound(fit.where(F.col("score") == lowest), turned, n_drawn - above)
    drawn = (F.col("n_words") >= least_words) & ((F.col("score") > lowest) | ((F.col("score") == lowest) & (turned >= tied)))

    order = [F.col("score").desc(), turned.desc(), "n_features", "weight", "row"]
    placed = scored.where(drawn).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = kept(placed.select(*names, F.monotonically_increasing_id().alias("place")))
    # The upper bits of a place are its partition's number, the lower 33 bits count the rows of the partition.
    partition = F.shiftright("place", 33)
    sizes = placed.groupBy(partition.alias("partition")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("partition", before.alias("before"))
    rank = F.col("before") + (F.col("place") - F.shiftleft("partition", 33)) + 1
    ranked = placed.withColumn("partition", partition).join(F.broadcast(starts), "partition")  # one row per partition
    ranked = ranked.select(*names, F.when(rank <= n_drawn, rank).alias("rank"))
    return ranked.unionByName(scored.where(~drawn).select(*names, F.lit(None).cast("long").alias("rank")))
