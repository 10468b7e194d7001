"""Spelling variants: words one edit apart, found through pivotal grams, and the frequent form each leads to.

Bigrams are ordered by how many words hold them, rare ones first. A word's *prefix* are its first three bigrams in this order,
and all others of the same rank as the third. Its *pivots* are two bigrams of the prefix that share no character, the
pair that the fewest words hold; dynamic programming over the places finds it. One edit spoils at most one of two such
bigrams. So of two words one edit apart, the one whose prefix ends at the rarer bigram (any of them, if equal) has a pivot that the
edit leaves alone: the other word has it too, moved by one place at most, and within its prefix, because it is no commoner
than the end of that. Hence:

1. Occurrences are counted per task before the shuffle.
2. Bigrams are counted over the words; their number is bounded by the alphabet, and tasks get the whole order.
3. Every word goes into the index with its two pivots, and looks pivots of other words up with the bigrams of its prefix. An
   edit behind a bigram leaves its place from the left and all before it, one before it its place from the right and all
   behind it: each bigram is known with either part of its word. What meets is verified, if lengths and letters allow it.
4. A word's form is the near word that occurs most, if it occurs far more often. Chains of forms are followed by doubling steps.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import kept
from tickloom.llm.text import only, slices

#: Fixed value: what a word consists of, before A-Z become lower case.
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
MOST_COUNTED = 500_000  # words that a task holds before it passes their counts on
LEAST_LENGTH = 4  # three bigrams


def _spelled(word: str, doc: int, thinned: int) -> str:
    """The word, in one of ``thinned`` cases without one of its characters; ``doc`` is the checksum of what goes before."""
    h = zlib.crc32(word.encode(), doc)
    if thinned and h % thinned == 0:
        at = h % len(word)
        return word[:at] + word[at + 1 :]
    return word


def word_counts(docs: DataFrame, least_length: int, thinned: int) -> DataFrame:
    """``word, n`` over all texts; ``docs`` has ``doc_id`` and a ``text`` without nulls."""
    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def passed_on() -> pa.RecordBatch:
            words, numbers = pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())
            counts.clear()
            return pa.RecordBatch.from_arrays([words, numbers], names=["word", "n"])

        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                doc = zlib.crc32(f"{doc_id}:".encode())
                for word, n in Counter(_RUN.findall(text.translate(_LOWER).decode())).items():
                    if len(word) >= least_length and len(word := _spelled(word, doc, thinned)) >= least_length:
                        counts[word] += n
                if len(counts) > MOST_COUNTED:
                    yield passed_on()
        yield passed_on()

    return named.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _grams() -> Column:
    places = F.sequence(F.lit(1), F.length("word") - 1)
    return F.transform(places, lambda i: F.substring(F.col("word"), i, F.lit(2)))


def prefix_and_pivots(word: str, order: dict[str, tuple[int, int]]) -> tuple[list[int], list[int]]:
    """The places of a word's prefix and of its two pivots; ``order`` has each bigram's place and its number of words."""
    grams = sorted((order[word[i : i + 2]][0], i) for i in range(len(word) - 1))
    last = grams[2][0]
    prefix = sorted(i for rank, i in grams if rank <= last)
    cost = [order[word[i : i + 2]][1] for i in prefix]
    # Over the places: the cheapest one so far that ends before the current one, and the cheapest pair.
    pair: tuple[int, int, int] | None = None
    single: tuple[int, int] | None = None
    waiting = 0
    for here, place in enumerate(prefix):
        while prefix[waiting] + 2 <= place:
            single = min(single or (cost[waiting], prefix[waiting]), (cost[waiting], prefix[waiting]))
            waiting += 1
        if single is not None:
            found = (single[0] + cost[here], single[1], place)
            pair = min(pair or found, found)
    return prefix, list(pair[1:])


def _index(words: DataFrame, order: dict[str, tuple[int, int]], pivots: bool) -> DataFrame:
    """``part, word, n, letters``: the parts of each word up to and from its pivots, or up to and from its prefix's bigrams.

    ``letters`` has a bit for each letter, modulo 63.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, of, letters = [], [], []
            for row, word in enumerate(batch.column("word").to_pylist()):
                prefix, two = prefix_and_pivots(word, order)
                mask = 0
                for c in set(word):
                    mask |= 1 << ord(c) % 63
                for i in two if pivots else prefix:
                    parts += ["<" + word[: i + 2], ">" + word[i:]]
                    of += [row, row]
                    letters += [mask, mask]
            cells = [pa.array(parts, pa.string()), *(batch.column(c).take(pa.array(of, pa.int64())) for c in ("word", "n")), pa.array(letters, pa.int64())]
            yield pa.RecordBatch.from_arrays(cells, names=["part", "word", "n", "letters"])

    return words.select("word", "n").mapInArrow(run, "part string, word string, n long, letters long")


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: every word with each word one edit away, both ways round.

    ``words`` are stored, different from each other and of four characters or more.
    """
    held = words.select(F.explode(F.array_distinct(_grams())).alias("gram")).groupBy("gram").count()
    counts = held.collect()  # at most the square of the alphabet's 90 letters
    order = {g: (i, n) for i, (n, g) in enumerate(sorted((r["count"], r["gram"]) for r in counts))}
    a = _index(words, order, pivots=True)
    b = _index(words, order, pivots=False).select("part", F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("letters").alias("other_letters"))
    # One edit takes one letter away and brings one at most.
    few = F.bit_count(F.col("letters").bitwiseXOR(F.col("other_letters"))) <= 2
    close = few & (F.col("word") != F.col("other")) & (F.abs(F.length("word") - F.length("other")) <= 1)
    met = a.join(b, "part").where(close).where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")
    back = met.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return met.unionAll(back).distinct()


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = 6,
    least_count: int = 5,
    ratio: int = 5,
    thinned: int = 199,
) -> DataFrame:
    """``word, form, root`` (string), ``n, n_near, form_n`` (long) for every word of the corpus.

    Words are runs of letters, A-Z in lower case, of ``least_length`` characters (four or more) that occur ``least_count`` times
    or more. A word is spelled without one character in the documents where the checksum of identifier and word
    is a multiple of ``thinned`` (0: never), and counts as what is left. ``form`` is the near word that occurs most, ties
    to the smaller in code-point order, if it occurs at least ``ratio`` (2 or more) times as often; ``root`` the end of the
    chain of forms. Null and empty texts have no words, texts of any length count whole, repeated rows count each. A null
    identifier counts as an empty one. An empty table gives an empty one. Names of other columns do not matter.
    """
    if least_length < LEAST_LENGTH or ratio < 2:
        raise ValueError("words have four characters or more, and forms occur at least twice as often")
    words = kept(word_counts(only(docs, id_col, text_col), least_length, thinned).where(F.col("n") >= least_count))
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    often = -F.col("best.n") >= ratio * F.col("n")
    forms = words.join(near, "word", "left").select(
        "word",
        F.when(often, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, -F.col("best.n")).alias("form_n"),
    )
    forms = kept(forms)
    # A form occurs more often than its word, so chains end; every round doubles the steps.
    steps = kept(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = kept(moved)
        steps = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    roots = forms.join(steps, "word", "left")
    return roots.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
