"""Line deduplication by overlapping windows of three lines.

Lines are what stands between line feeds. Lines with a word count; blank ones take part in no window and always stay.
A window is three consecutive counting lines of one document, known by 128 hash bits. Its first occurrence, by document
identifier and then by place, stays; all lines that any later occurrence covers go. Texts of one or two counting lines
have no window and stay whole.

Only hashes are shuffled until the lines to remove are known. Windows that occur once leave with the first aggregation,
which combines before the shuffle, so a window that a third of all documents share costs one row per task there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.store import kept
from tickloom.llm.text import text_key, text_of

#: A line counts if it has a character outside the six ASCII white-space characters.
_WORD = r"[^\x20\x09-\x0D]"
_DOC = ["doc_id", "k1", "k2"]


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"), *more)
    return named.select("*", *text_key())


def _windows(docs: DataFrame) -> DataFrame:
    """``doc_id, k1, k2, n, at, w1, w2``: the window's number in its document, its three line numbers and its hash."""
    numbered = F.transform(F.split("text", "\n"), lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    counting = docs.select(*_DOC, F.filter(numbered, lambda x: x["line"].rlike(_WORD)).alias("lines"))
    hashed = F.transform("lines", lambda x: F.struct(*(F.xxhash64(F.lit(s), x["line"]).alias(f"h{s}") for s in (1, 2)), x["i"].alias("i")))
    placed = counting.select(*_DOC, hashed.alias("lines"), F.size("lines").alias("count")).select(
        *_DOC, "lines", F.explode_outer(F.when(F.col("count") >= 3, F.sequence(F.lit(0), F.col("count") - 3))).alias("n")
    )
    three = [F.get("lines", F.col("n") + k) for k in range(3)]
    hashes = [F.xxhash64(*(x[f"h{s}"] for x in three)).alias(f"w{s}") for s in (1, 2)]
    return placed.where("n is not null").select(*_DOC, "n", F.array(*(x["i"] for x in three)).alias("at"), *hashes)


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, k1, k2, removed``: the line numbers (from 0, sorted) to remove, for documents that lose any.

    ``k1, k2`` stand for the text. Documents that share an identifier are ordered by them; repeated rows are one
    document, all rows of which lose the same lines. Null identifiers come last. Null and empty texts lose nothing; an
    empty table gives no rows.
    """
    windows, w = _windows(_keyed(docs, id_col, text_col)), ["w1", "w2"]
    counts = windows.groupBy(*w).agg(F.count("*").alias("times"), F.min("doc_id").alias("first_id"))
    # Stored, so that both sides of the join are plain exchanges, of which Spark splits a hot window's partition.
    repeated = kept(counts.where("times > 1").drop("times"))
    found = windows.join(repeated, w)
    elsewhere = ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    # Within the first document, its first place stays; one task at most ranks the places of one identifier.
    place = F.rank().over(Window.partitionBy(*w).orderBy("k1", "k2", "n"))
    later = found.where(elsewhere).select(*_DOC, "at").unionAll(
        found.where(~elsewhere).withColumn("place", place).where("place > 1").select(*_DOC, "at")
    )
    lines = later.select(*_DOC, F.explode("at").alias("i")).distinct()
    return lines.groupBy(*_DOC).agg(F.sort_array(F.collect_list("i")).alias("removed"))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, the text replaced by the lines that stay, and ``_n_lines``, ``_n_removed`` (long).

    A null text stays null. A text all of whose counting lines go keeps its blank lines only.
    """
    text = F.col(f"`{text_col}`")
    key = [F.xxhash64(F.lit(seed), text_of(text_col)) for seed in (1, 2)]
    gone = removed_lines(docs, id_col, text_col).select(F.col("doc_id").alias("_id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("removed").alias("_removed"))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("_id")) & (key[0] == F.col("_k1")) & (key[1] == F.col("_k2"))
    joined = docs.join(gone, same, "left")
    lines = F.split(text, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_removed"))
    left = F.when(F.col("_removed").isNull(), text).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    return joined.select(
        *(left.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns),
        F.coalesce(F.size(lines), F.lit(1)).cast("long").alias("_n_lines"),
        F.coalesce(F.array_size("_removed"), F.lit(0)).cast("long").alias("_n_removed"),
    )
