"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: what separates words, the six ASCII white-space characters.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def text_of(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def only(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Identifier and whole text under fixed names; other columns cannot clash with what an operator adds."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"))


def text_key(column: str = "text") -> list[Column]:
    """128 bits that stand for a text, as two columns ``k1`` and ``k2``."""
    return [F.xxhash64(F.lit(1), F.col(column)).alias("k1"), F.xxhash64(F.lit(2), F.col(column)).alias("k2")]


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of one are about ``most_bytes``, or one longer text."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + (n or 0) > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if len(lengths) > start:
            yield batch.slice(start)
