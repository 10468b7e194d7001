"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Words are maximal runs of letters and digits, lower-cased. A document overlaps a benchmark item if, with the item laid
against it at some offset, one window of ``WINDOW`` consecutive words has at least ``MATCHES`` equal words. Items shorter
than the window are one window of their own length that needs the same share of equal words, rounded up: all words of items of
five or fewer.

Two fixed masks of six positions find candidates: however three substitutions fall among sixteen words, one mask has a
place that touches none of them (the tests try all cases), so the search loses nothing. Shorter items are found by runs
of words that the pigeonhole leaves untouched. Every hit is then verified word by word in the windows around it.

The benchmark is the stated query set: it goes to the executors in blocks of at most ``BLOCK_WORDS`` words or so, and
every block meets all documents as they are scanned. Documents are not shuffled; only verified pairs are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import only, text_key

#: Positions that a seed reads; the words between are ignored.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 8, 9, 10))
WINDOW, MATCHES = 16, 13
BLOCK_WORDS = 500_000


def short_need(n: int) -> int:
    """Equal words that an item of n < WINDOW words needs."""
    return -(-n * MATCHES // WINDOW)


def short_run(n: int) -> int:
    """With that many equal words, so many of them are consecutive."""
    return n // (n - short_need(n) + 1)


SHORT_RUNS = {n: short_run(n) for n in range(1, WINDOW)}


def _word_hashes(text: str) -> Column:
    words = F.array_remove(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed(words: str, mask: tuple[int, ...], at: Column) -> Column:
    """The hash of one mask at one place, null where it reaches beyond the text; the mask is part of the hash."""
    inside = at + max(mask) < F.size(F.col(words))
    return F.when(inside, F.xxhash64(F.lit(sum(1 << m for m in mask)), *(F.get(F.col(words), at + m) for m in mask)))


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    items = only(benchmark, item_col, text_col).select(F.col("doc_id").alias("item_id"), *text_key(), _word_hashes("text").alias("item_words"))
    items = items.withColumnsRenamed({"k1": "item_k1", "k2": "item_k2"}).withColumn("n_item", F.size("item_words"))
    return items.where(F.col("n_item") > 0).distinct()


def _item_seeds(items: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    n = F.col("n_item")
    run = reduce(lambda c, x: c.when(n == x[0], x[1]), SHORT_RUNS.items(), F.when(F.lit(False), 0))
    placed = items.select("*", F.posexplode("item_words").alias("item_seed_at", "_word"))
    kinds = [F.struct(F.when(n >= WINDOW if m in MASKS else run == len(m), _seed("item_words", m, F.col("item_seed_at"))).alias("seed"), F.lit(max(m) + 1).alias("span")) for m in masks]
    seeds = placed.withColumn("s", F.explode(F.array(*kinds))).select("*", "s.seed", "s.span").where("seed is not null")
    return seeds.select("seed", "span", "item_seed_at", "item_id", "item_words", "n_item")


def _best_window() -> Column:
    """The best verified window around a hit, as a struct of the number of equal words and its place in the item."""
    n, at, shift = F.col("n_item"), F.col("item_seed_at"), F.col("doc_seed_at") - F.col("item_seed_at")
    width = F.least(F.lit(WINDOW), n)
    starts = F.sequence(F.greatest(F.lit(0), at + F.col("span") - width), F.least(at, n - width))

    def equal(start: Column) -> Column:
        same = lambda j: (F.get(F.col("words"), j + shift) == F.get(F.col("item_words"), j)).cast("int")
        return F.aggregate(F.sequence(start, start + width - 1), F.lit(0), lambda acc, j: acc + F.coalesce(same(j), F.lit(0)))

    return F.array_max(F.transform(starts, lambda s: F.struct(equal(s).alias("n_equal"), (-s).alias("minus_at"))))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """One row per document and benchmark item that overlap: ``doc_id, k1, k2, item_id, n_equal, doc_at``.

    ``n_equal`` is the most equal words of one window around a seed hit, ``doc_at`` the first word (from 0) of the first
    verified window. ``k1, k2`` stand for the text, so that different rows with one identifier stay apart; repeated rows
    of either table give one pair. Null texts count as empty; empty texts and tables give no rows; null identifiers are
    kept as they are. Other columns are not looked at.
    """
    items = _items(benchmark, item_col, item_text_col)
    sizes = items.groupBy(F.least("n_item", F.lit(WINDOW)).alias("n")).agg(F.sum("n_item").alias("words")).collect()
    short_masks = [tuple(range(r)) for r in sorted({SHORT_RUNS[s["n"]] for s in sizes if s["n"] < WINDOW})]
    masks = [*(MASKS if any(s["n"] == WINDOW for s in sizes) else ()), *short_masks]
    blocks = max(1, -(-2 * sum(s["words"] for s in sizes) // BLOCK_WORDS)) if sum(s["words"] for s in sizes) > BLOCK_WORDS else 1
    block_of = F.pmod(F.col("item_k1"), F.lit(blocks))
    if not masks:
        masks = list(MASKS)
    words = only(docs, id_col, text_col).select("doc_id", *text_key(), _word_hashes("text").alias("words"))
    # Outer, since Spark puts a filter on the array before a plain explode, which would split every text twice.
    placed = words.select("*", F.posexplode_outer("words").alias("doc_seed_at", "_word"))
    seeds = placed.withColumn("seed", F.explode(F.array(*(_seed("words", m, F.col("doc_seed_at")) for m in masks)))).drop("_word")
    need = reduce(lambda c, n: c.when(F.col("n_item") == n, short_need(n)), SHORT_RUNS, F.when(F.lit(False), 0)).otherwise(MATCHES)
    found = []
    for b in range(blocks):
        block = _item_seeds(items.where(block_of == b), masks)
        # The verification is exploded, not filtered: as a filter it would become a condition of the join and keep the
        # join and all that precedes it out of generated code.
        hits = seeds.join(F.broadcast(block), "seed").withColumn("best", F.explode_outer(F.array(_best_window()))).where(F.col("best.n_equal") >= need)
        found.append(hits.select("doc_id", "k1", "k2", "item_id", "best.n_equal", (F.col("doc_seed_at") - F.col("item_seed_at") - F.col("best.minus_at")).alias("doc_at")))
    pairs = reduce(DataFrame.unionAll, found)
    return pairs.groupBy("doc_id", "k1", "k2", "item_id").agg(F.max("n_equal").alias("n_equal"), F.greatest(F.min("doc_at"), F.lit(0)).alias("doc_at"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns: str) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, contaminated, n_items, best_equal, item_ids`` (sorted, without nulls)."""
    hits = overlaps(docs, benchmark, id_col, text_col, **columns)
    by_doc = hits.groupBy("doc_id", "k1", "k2").agg(
        F.count("*").alias("n_items"), F.max("n_equal").alias("best_equal"), F.sort_array(F.collect_set("item_id")).alias("item_ids")
    )
    d, h = only(docs, id_col, text_col).select("doc_id", *text_key()).alias("d"), by_doc.alias("h")
    same = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.k1") == F.col("h.k1")) & (F.col("d.k2") == F.col("h.k2"))
    return d.join(h, same, "left").select(
        "d.doc_id",
        F.col("h.n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("best_equal", F.lit(0)).cast("long").alias("best_equal"),
        F.coalesce("item_ids", F.array().cast(by_doc.schema["item_ids"].dataType)).alias("item_ids"),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns: str) -> DataFrame:
    """The rows of ``docs``, all columns, that overlap no benchmark item."""
    hit = overlaps(docs, benchmark, id_col, text_col, **columns).select(F.col("doc_id").alias("_id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
    k1, k2 = (F.xxhash64(F.lit(n), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))) for n in (1, 2))
    return docs.join(hit, F.col(f"`{id_col}`").eqNullSafe(F.col("_id")) & (k1 == F.col("_k1")) & (k2 == F.col("_k2")), "left_anti")
