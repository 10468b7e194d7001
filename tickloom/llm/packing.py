"""Packing documents into sequences of fixed length, best fit by the sum of squares.

A document becomes its token ids and one end id; one longer than a sequence is cut into full pieces, the shorter piece
first. A full piece is a sequence of its own. Every other piece goes into the open sequence with room for it that
makes the sum of N(g)^2 over all gaps g smallest, N(g) being the number of open sequences with g places left; this keeps
any gap from piling up, so that later pieces find one that they fill exactly. A new sequence is opened only where none
has room: since the longest pieces come first, that needs fewer than the choice of a new one by the sum of squares.

Texts are tokenized where they are read and only a row per piece travels: all pieces are dealt round robin, in equal
shares of about ``per_task`` pieces, and each share is packed by itself, longest pieces first. The shares do not depend
on any key, so no hot identifier or length gathers anywhere, and a repeated task gives the same rows. A share leaves at
most a few sequences partly filled.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tickloom.llm.text import only, slices
from tickloom.sources.scratch import settled

LENGTH, END_ID = 1024, 2
PER_TASK = 200_000
#: Runs of white space of this length are cut out by themselves; the vocabulary's pattern overflows at some 700,000.
LONG_SPACE = 1 << 16
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_SPACE)


@lru_cache(maxsize=2)
def _encoder(ranks_path: str):
    """The byte-level vocabulary, read once per worker. Its rank file gives the ids of its tokenizers file (see tests)."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})


def token_ids(texts: list[str], ranks_path: str) -> list[list[int]]:
    """The ids of each text. Long runs of white space are merged as the pattern would cut them: all of a run at the end of the
    text, elsewhere all but its last character, which starts what follows."""
    encoder, out = _encoder(ranks_path), []
    for text in texts:
        ids, done = [], 0
        for run in _SPACES.finditer(text) if len(text) >= LONG_SPACE else ():
            end = run.end() - (run.end() < len(text))
            ids += encoder.encode(text[done : run.start()], allowed_special="all")
            ids += encoder._encode_single_piece(text[run.start() : end])
            done = end
        out.append(ids + encoder.encode(text[done:], allowed_special="all"))
    return out


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full ones, after a shorter first one if n is no multiple."""
    first = n % length
    return ([(0, first)] if first else []) + [(at, length) for at in range(first, n, length)]


def pieces(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: one row per piece. A null or empty text is its end id alone."""
    rows = only(docs, id_col, text_col)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            of_row, piece, start, size, crc = [], [], [], [], []
            for row, ids in enumerate(token_ids(batch.column("text").to_pylist(), ranks_path)):
                raw = np.asarray([*ids, end_id], "<u4").tobytes()
                for k, (at, n) in enumerate(cut(len(ids) + 1, length)):
                    of_row.append(row), piece.append(k), start.append(at), size.append(n)
                    crc.append(zlib.crc32(raw[4 * at : 4 * (at + n)]))
            out = [batch.column("doc_id").take(pa.array(of_row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, size, crc))]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, placed in the given order; every length is from 1 to the capacity."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # numbers of the sequences with each gap
    count = np.zeros(capacity + 1, np.int64)
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    none_open = np.iinfo(np.int64).max
    for i, n in enumerate(lengths.tolist()):
        # From gap g to gap g - n the sum of squares changes by 2 (N(g - n) - N(g)) + 2, by 1 - 2 N(g) if the gap is filled.
        change = 2 * (count[: capacity + 1 - n] - count[n:]) + 2
        change[0] = 1 - 2 * count[n]
        change[count[n:] == 0] = none_open
        gap = int(change.argmin()) + n  # of equal changes the smallest gap
        if change[gap - n] == none_open:
            gap = capacity
            number, made = made, made + 1
        else:
            number = open_bins[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = number, capacity - gap
        if gap > n:
            open_bins[gap - n].append(number)
            count[gap - n] += 1
    return bins, offsets


def packed(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID, per_task: int = PER_TASK) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: one row per piece of every row of ``docs``.

    Null and empty texts are one piece, the end id; rows that share an identifier, null included, are packed each for
    itself; an empty table gives an empty one. Very long texts are read whole, whatever they consist of. Sequences are gapless from offset 0 and never longer than ``length``.
    """
    cut_up = settled(pieces(docs, ranks_path, id_col, text_col, length, end_id))
    rest = cut_up.where(F.col("length") < length)
    whole = cut_up.where(F.col("length") == length).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    shares = max(1, -(-rest.count() // per_task))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        share = pa.Table.from_batches(held)
        # Longest first; ties by what identifies a piece, so that a task that runs again packs the same way.
        share = share.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = sum_of_squares(share.column("length").to_numpy(), length)
        first = TaskContext.get().partitionId() << 32
        out = share.append_column("sequence_id", pa.array(bins + first)).append_column("offset", pa.array(offsets))
        yield from out.to_batches(50_000)

    schema = StructType([*cut_up.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return rest.repartition(shares).mapInArrow(run, schema).unionByName(whole)
