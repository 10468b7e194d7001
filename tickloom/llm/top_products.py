"""Exact search for the largest inner products, vectors in descending order of length.

Components become whole numbers, so that scores and ties are exact. The singular vectors of all vectors (from the sums of
products of their components) rotate them, which leaves inner products as they are and moves most of each into the first
components. Vectors are cut into slots of bounded size in descending order of length, queries into blocks.

1. Every block meets the slot of the longest vectors. The k-th best score of a query there is its threshold.
2. By Cauchy and Schwarz no product exceeds the product of the lengths: a block meets those slots only whose longest vector can
   still reach a threshold. Within a slot vectors follow in descending order until none can.
3. The partial product over the first rotated components, plus the product of the lengths of the rest, bounds a score. Pairs
   whose bound stays below the threshold go, after a quarter and after half of the components; the others are computed
   exactly, and the best of them raise the threshold.
4. The best of a query's slots are ranked together.

A block and a slot come together by an equi-join on their numbers; both have a bounded size, however many vectors are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.store import kept

SLOT_BYTES, BLOCK_BYTES = 8 << 20, 2 << 20
RUN = 1024  # vectors that a block of queries is compared with at once
#: Relative error that bounds allow for, far above that of sums of doubles.
SLACK = 1e-9
_EXACT, _HUGE = float(1 << 53), 10**308


def _matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Lists as rows of a matrix, filled up with zeros to the longest or to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), max(width, lengths.max(initial=0))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, length, q``: every component times ``scale``, floored. Vectors that hold a null or no finite number go."""
    kind = vectors.schema[id_col].dataType.simpleString()
    plain = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("x")).where("x is not null")
    plain = plain.where(~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            with np.errstate(over="ignore"):
                whole = np.floor(scale * x.flatten().to_numpy(zero_copy_only=False))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(pc.list_value_length(x).to_numpy()))).astype(np.int32)), pa.array(whole))
            rows = _matrix(lists)
            there = np.isfinite(rows).all(axis=1)
            with np.errstate(over="ignore", invalid="ignore"):
                lengths = np.sqrt((rows**2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(lengths), lists], names=["vec_id", "length", "q"]).filter(pa.array(there))

    return plain.mapInArrow(run, f"vec_id {kind}, length double, q array<double>")


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """The right singular vectors of all vectors, by descending singular values; ``width`` squared numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = _matrix(batch.column("q"), width)
            with np.errstate(all="ignore"):
                total += rows.T @ rows
        at = np.flatnonzero(np.triu(np.ones((width, width), bool)).ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["at", "v"])

    sums = np.zeros(width * width)
    for at, v in vectors.select("q").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        sums[at] = v
    square = sums.reshape(width, width)
    if not np.isfinite(square).all():
        return np.eye(width)
    return np.linalg.eigh(square + np.triu(square, 1).T)[1][:, ::-1].copy()


def exact_scores(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Inner products of rows of whole numbers, none above ``most``; beyond what doubles hold, by long integers."""
    if most < _EXACT:
        return np.einsum("ij,ij->i", a, b)
    out = np.empty(len(a), object)
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        out[i] = sum(int(v) * int(w) for v, w in zip(x, y))
    return out


def _doubles(score: np.ndarray) -> np.ndarray:
    return score if score.dtype == float else np.array([float(max(-_HUGE, min(_HUGE, s))) for s in score], float)


def best_of(qi: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """The places of each query's ``k`` highest scores, ties to the smaller identifier, nulls last."""
    if score.dtype == object:
        places = _id_order(ids)
        order = np.array(sorted(range(len(qi)), key=lambda i: (qi[i], -score[i], places[i], rows[i])), np.int64)
    else:
        order = np.lexsort((rows, _id_order(ids), -score, qi))
    of = qi[order]
    starts = np.concatenate(([0], np.flatnonzero(of[1:] != of[:-1]) + 1)) if len(of) else np.zeros(0, np.int64)
    place = np.arange(len(of)) - np.repeat(starts, np.diff(np.append(starts, len(of))))
    return order[place < k]


def _id_order(ids: np.ndarray) -> np.ndarray:
    known = np.array([i is not None for i in ids], bool)
    values, out = np.array([i for i in ids if i is not None]), np.full(len(ids), len(ids), np.int64)
    out[known] = np.unique(values, return_inverse=True)[1] if len(values) else 0
    return out


def search(queries: pa.Table, slot: pa.Table, turn: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query numbers, vector numbers and scores of the best of a slot, and each query's threshold afterwards.

    The vectors of ``slot`` are in descending order of length. Scores below the thresholds of ``queries`` do not count.
    """
    q, c = (_matrix(t.column("q"), len(turn)) for t in (queries, slot))
    q_len, c_len = (t.column("length").to_numpy() for t in (queries, slot))
    q_row, c_row = (t.column("row").to_numpy() for t in (queries, slot))
    ids = np.array(slot.column("vec_id").to_pylist(), object)
    least = queries.column("threshold").to_numpy().copy()
    q_turned, c_turned = q @ turn, c @ turn
    most = float(q_len.max(initial=0) * c_len.max(initial=0))
    kind = float if most < _EXACT else object
    qi, ci, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)
    cuts = sorted({max(1, len(turn) // 4), max(1, len(turn) // 2)})
    rest = lambda x, cut: np.sqrt((x[:, cut:] ** 2).sum(axis=1))
    left = [(cut, rest(q_turned, cut), rest(c_turned, cut)) for cut in cuts]
    for start in range(0, len(c), RUN):
        stop = min(start + RUN, len(c))
        with np.errstate(all="ignore"):
            slack = SLACK * (1 + q_len * c_len[start])
            active = np.flatnonzero(~(q_len * c_len[start] + slack < least))
            if not len(active):
                break
            cut, q_rest, c_rest = left[0]
            bound = q_turned[active, :cut] @ c_turned[start:stop, :cut].T + np.outer(q_rest[active], c_rest[start:stop])
            a, b = np.nonzero(~(bound < (least - slack)[active, None]))
            a, b = active[a], b + start
            for cut, q_rest, c_rest in left[1:]:
                keep = np.zeros(len(a), bool)
                for at in range(0, len(a), 1 << 16):
                    i, j = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
                    bound = np.einsum("ij,ij->i", q_turned[i, :cut], c_turned[j, :cut]) + q_rest[i] * c_rest[j]
                    keep[at : at + (1 << 16)] = ~(bound < (least - slack)[i])
                a, b = a[keep], b[keep]
        other = q_row[a] != c_row[b]
        a, b = a[other], b[other]
        parts = [exact_scores(q[a[at : at + (1 << 16)]], c[b[at : at + (1 << 16)]], most) for at in range(0, len(a), 1 << 16)]
        new = np.concatenate([np.zeros(0, kind), *parts])
        good = np.array(new >= least[a], bool)
        qi, ci, score = np.concatenate((qi, a[good])), np.concatenate((ci, b[good])), np.concatenate((score, new[good]))
        best = best_of(qi, score, ids[ci], c_row[ci], k)
        qi, ci, score = qi[best], ci[best], score[best]
        full = np.flatnonzero(np.bincount(qi, minlength=len(q)) == k)
        if len(full):
            last = np.searchsorted(qi, full, "right") - 1
            least[full] = np.maximum(least[full], _doubles(score[last]) if kind is float else np.nextafter(_doubles(score[last]), -np.inf))
    return qi, ci, score, least


def top_products(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the ``k`` highest scores of each query, fewer if there are fewer vectors.

    ``is_query`` is a condition on ``vec_id``; every vector but the query's own row is a candidate. Scores are inner
    products of whole components, ties go to the smaller identifier, null identifiers last. Vectors that are null, or hold
    nulls or numbers that are not finite (also after scaling), take no part. Shorter vectors count as filled up with
    zeros, so that an empty one has the score 0 with all. Rows that repeat an identifier are vectors each by itself, and equal
    rows found for a query come in any order. Scores beyond a long are cut to its range, in the order of their doubles. The
    driver and each task hold the rotation, the square of the longest vector's components, which does not grow with the rows.
    An empty table gives an empty one. Names of other columns do not matter.
    """
    id_kind = vectors.schema[id_col].dataType.simpleString()
    result = f"query_id {id_kind}, query_row long, vec_id {id_kind}, row long, score long, rough double"
    whole = whole_vectors(vectors, id_col, vector_col, scale)
    order = [F.col("length").desc(), F.xxhash64("vec_id"), F.col("vec_id")]
    ranged = whole.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = kept(ranged.withColumn("row", F.monotonically_increasing_id()))
    width, n_queries = stored.agg(F.max(F.size("q")), F.count_if(is_query)).first()
    if not n_queries:
        return vectors.sparkSession.createDataFrame([], f"query_id {id_kind}, rank int, vec_id {id_kind}, score long")
    width = max(width, 1)
    turn = rotation(stored, width)
    # A partition's rows are in descending order, and so are partitions: slots are runs of a power of two rows.
    bits = max(4, (SLOT_BYTES // (8 * width)).bit_length() - 1)
    slotted = stored.withColumn("slot", F.shiftright("row", bits))
    n_blocks = -(-n_queries * 8 * width // BLOCK_BYTES)
    block = F.pmod(F.xxhash64("row"), F.lit(n_blocks)).alias("block")
    queries = stored.where(is_query).select("vec_id", "row", "length", "q", block, F.lit(float("-inf")).alias("threshold"))

    slots = kept(slotted.groupBy("slot").agg(F.max("length").alias("longest")))
    first = slots.agg(F.min("slot")).first()[0]

    def seed(left: pa.Table, right: pa.Table) -> pa.Table:
        least = search(left, right.sort_by([("length", "descending")]), turn, k)[3]
        return left.drop_columns(["threshold"]).append_column("threshold", pa.array(least, pa.float64()))

    # Every block meets the first slot.
    longest = slotted.where(F.col("slot") == first).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>")))
    longest = longest.select("block", "vec_id", "row", "length", "q")
    schema = f"vec_id {id_kind}, row long, length double, q array<double>, block long, threshold double"
    queries = kept(queries.groupBy("block").cogroup(longest.groupBy("block")).applyInArrow(seed, schema))

    # The length that vectors need for the easiest query of a block.
    need = F.min(F.when((F.col("threshold") <= 0) | (F.col("length") == 0), F.lit(0.0)).otherwise(F.col("threshold") / F.col("length")))
    blocks = queries.groupBy("block").agg(need.alias("need"))
    pairs = slots.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>"))).join(blocks, "block")
    pairs = kept(pairs.where(F.col("longest") * (1 + SLACK) >= F.col("need")).select("block", "slot"))
    left = queries.join(pairs, "block")
    right = slotted.join(pairs, "slot").select("block", "slot", "vec_id", "row", "length", "q")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by([("length", "descending")])
        qi, ci, score, _ = search(left, right, turn, k)
        ends = (1 << 63) - 1
        cells = [left.column(c).take(pa.array(qi)) for c in ("vec_id", "row")] + [right.column(c).take(pa.array(ci)) for c in ("vec_id", "row")]
        whole = pa.array([max(-ends - 1, min(ends, int(s))) for s in score], pa.int64())
        return pa.Table.from_arrays([*cells, whole, pa.array(_doubles(score))], names=["query_id", "query_row", "vec_id", "row", "score", "rough"])

    found = left.groupBy("block", "slot").cogroup(right.groupBy("block", "slot")).applyInArrow(meet, result)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("rough").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
