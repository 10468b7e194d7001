"""Likelihood of a text under a unigram model of subwords, summed over all ways to cut the text into them.

The pieces are those of an existing vocabulary, bytes among them, so that every text can be cut. A word, with the blank
before it, is a lattice: every piece that matches somewhere is an edge. The forward recursion adds up, in logarithms, the
probabilities of all paths; a text's probability is the product over its words and the end piece. Pieces never cross
words, so this is the marginal probability over all segmentations of the text.

The vocabulary's own scores weight the pieces at first. They are re-estimated by expectation and maximization on all
words of the training documents: each round adds up, with the forward and backward recursions, how often every piece is
expected to be used, over the table of distinct words and their counts. Tasks return one row per piece.

Every training word is kept with its count and its lattice's probability. Scoring needs both for every word of every
document: words above a count that at most ``COMMON`` words reach are looked up where the text is read, the others are
joined by word, and the lattice of words that training never met is summed after the join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import kept
from tickloom.llm.text import only, slices

END = b""
#: At most so many words, of at most COMMON_BYTES each, are sent to every executor with their counts.
COMMON, COMMON_BYTES = 100_000, 32
ROUNDS, PRIOR = 2, 1000.0
_FLUSH = 200_000
_BLOCK = 16


@lru_cache(maxsize=2)
def vocabulary(model_path: str) -> tuple[dict[bytes, int], np.ndarray]:
    """Pieces and their prior probabilities; the table maps a piece to its number and a mere beginning of one to -1.

    The scores of a merge vocabulary are ranks, which Zipf's law turns into probabilities; other scores are taken as
    logarithms of probabilities. The end piece is number 0, as likely as a piece of the first rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    scores = [model.get_score(i) for i in ids]
    ranks = all(s == int(s) and s <= 0 for s in scores)
    weights, table = [1 / 11 if ranks else 1.0], {}
    for i, score in zip(ids, scores):
        name = model.id_to_piece(i)
        piece = bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()
        if b" " in piece[1:]:
            continue  # never inside one word
        weight = 1 / (10 - score) if ranks else math.exp(score)
        if model.is_byte(i) and ranks:
            weight = 1 / (10 + len(ids))
        if table.get(piece, -1) >= 0:
            weights[table[piece]] += weight
        else:
            table[piece] = len(weights)
            weights.append(weight)
        for n in range(1, len(piece)):
            table.setdefault(piece[:n], -1)
    for b in range(256):  # whatever the vocabulary is, every text can be cut
        if table.get(bytes([b]), -1) < 0:
            table[bytes([b])] = len(weights)
            weights.append(min(weights))
    prior = np.array(weights)
    return table, prior / prior.sum()


def log_probability(word: bytes, table: dict[bytes, int], log_p: list[float]) -> float:
    """Natural logarithm of the summed probability of all segmentations of a blank and the word."""
    text, get, exp, log = b" " + word, table.get, math.exp, math.log
    n = len(text)
    terms: list[list[float]] = [[] for _ in range(n + 1)]
    terms[0].append(0.0)
    for i in range(n + 1):
        here = terms[i]
        if len(here) > 1:
            most = max(here)
            here = most + log(sum([exp(t - most) for t in here]))
        else:
            here = here[0]
        for j in range(i + 1, n + 1):
            piece = get(text[i:j])
            if piece is None:
                break
            if piece >= 0:
                terms[j].append(here + log_p[piece])
    return here


def expected_use(word: bytes, times: float, table: dict[bytes, int], p: list[float], use: list[float]) -> None:
    """Add the expected number of uses of every piece in ``times`` occurrences of the word, by forward and backward sums.

    Sums are plain probabilities, divided by their total wherever they pass a block of bytes, so that none vanishes.
    """
    text, get = b" " + word, table.get
    n = len(text)
    forward, edges, scale = [0.0] * (n + 1), [], {}
    forward[0] = 1.0
    for i in range(n):
        if i and i % _BLOCK == 0:  # every path passes one of the places up to i + the longest piece
            scale[i] = sum(forward[i:])
            forward[i:] = [x / scale[i] for x in forward[i:]]
        here = forward[i]
        for j in range(i + 1, n + 1):
            piece = get(text[i:j])
            if piece is None:
                break
            if piece >= 0:
                forward[j] += here * p[piece]
                edges.append((i, j, piece))
    backward = [0.0] * (n + 1)
    backward[n] = times / forward[n]
    last = n
    for i, j, piece in reversed(edges):  # by descending start, so that every end's sum is complete
        while last > i:
            # Sums at places from a block on are in that block's scale; those before it are not.
            if last in scale:
                backward[last:] = [x / scale[last] for x in backward[last:]]
            last -= 1
        share = p[piece] * backward[j]
        backward[i] += share
        use[piece] += forward[i] * share


def _is_training(held_out_of: int = 10) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % held_out_of != 0


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, c``: the words, and the end (the empty word) of every document; ``docs`` has ``text`` without nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in slices(batches, "text"):
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                held.update(raw.lower().split())
                held[END] += 1
            if len(held) > _FLUSH:
                yield _counted(held)
                held = Counter()
        if held:
            yield _counted(held)

    parts = docs.select("text").mapInArrow(run, "word binary, c long")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return kept(parts.groupBy("word").agg(F.sum("c").alias("c")).repartition(n))


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])


def trained(counts: DataFrame, model_path: str, rounds: int = ROUNDS, prior: float = PRIOR) -> np.ndarray:
    """Probabilities of the pieces, by ``rounds`` of expectation and maximization from the vocabulary's own.

    ``prior`` is how many uses the vocabulary's probabilities count for. As many rows as there are pieces are collected.
    """
    table, start = vocabulary(model_path)
    p = start
    for _ in range(rounds):
        sent = counts.sparkSession.sparkContext.broadcast(p)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            pieces, p = vocabulary(model_path)[0], sent.value.tolist()
            use = [0.0] * len(p)
            for batch in batches:
                for word, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist()):
                    if word == END:
                        use[0] += c
                    else:
                        expected_use(word, c, pieces, p, use)
            used = [i for i, x in enumerate(use) if x]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([use[i] for i in used], pa.float64())], names=["piece", "use"])

        uses = counts.mapInArrow(run, "piece long, use double").groupBy("piece").agg(F.sum("use").alias("use")).toArrow()
        total = np.zeros(len(start))
        total[uses.column("piece").to_numpy()] = uses.column("use").to_numpy()
        p = (total + prior * start) / (total.sum() + prior)
        sent.unpersist()
    return p


def weighed(counts: DataFrame, model_path: str, p: np.ndarray) -> DataFrame:
    """``word, c, log_p``: the counts and the natural logarithm of each word's probability; 0 for the end."""
    sent = counts.sparkSession.sparkContext.broadcast(np.log(p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, log_p = vocabulary(model_path)[0], sent.value.tolist()
        for batch in batches:
            values = [log_probability(w, pieces, log_p) if w != END else 0.0 for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(values, pa.float64())], names=["word", "c", "log_p"])

    return kept(counts.mapInArrow(run, "word binary, c long, log_p double"))


def _level() -> Column:
    return F.floor(F.log2("c") * 8)


def _common(words: DataFrame) -> tuple[int, dict[bytes, tuple[int, float]]]:
    """A level of counts and the words that reach it, at most COMMON."""
    short = words.where(F.length("word") <= COMMON_BYTES)
    levels = short.groupBy(_level().alias("level")).agg(F.count("*").alias("n")).collect()
    least, room = None, COMMON
    for row in sorted(levels, key=lambda r: -r["level"]):
        room -= row["n"]
        if room < 0:
            break
        least = row["level"]
    if least is None:
        return 0, {}
    rows = short.where(_level() >= least).toArrow()
    return least, dict(zip(rows.column("word").to_pylist(), zip(rows.column("c").to_pylist(), rows.column("log_p").to_pylist())))


def scored(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", held_out_of: int = 10) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``base_score`` is the word model's log10 probability with 0.1 added to every count, ``score`` the lattice model's.
    Held out are rows whose crc32 of the identifier as text, empty for null, is a multiple of ``held_out_of``. A null or
    empty text is its end token alone. Rows that share an identifier are scored each for itself; an empty table gives an
    empty one, and without training rows all counts are 0 and the vocabulary's own probabilities hold.
    """
    rows = only(docs, id_col, text_col)
    counts = word_counts(rows.where(_is_training(held_out_of)))
    p = trained(counts, model_path)
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_all = total["n"]
    scale = math.log10(n_all + 0.1 * (total["v"] + 1))
    words = weighed(counts, model_path, p)
    level, common = _common(words)
    sent = docs.sparkSession.sparkContext.broadcast((common, np.log(p)))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"rid long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_part double, score_part double, rare array<binary>, times array<int>"
    names = [part.split()[0] for part in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, log_p = sent.value
        known = {w: (math.log10(c + 0.1), x) for w, (c, x) in known.items()}
        rid, end = TaskContext.get().partitionId() << 40, float(log_p[0])
        for batch in slices(batches, "text"):
            out = []
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                split = raw.lower().split()
                tally = Counter(split)
                tally[END] = 1
                n_known, base, score, rare, times = 0, 0.0, end, [], []
                for w, k in tally.items():
                    if (x := known.get(w)) is not None:
                        n_known += k
                        base += k * x[0]
                        score += k * x[1]
                    else:
                        rare.append(w)
                        times.append(k)
                out.append((rid, len(split) + 1, n_known, base, score, rare, times))
                rid += 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32())]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays([arrays[0], batch.column("doc_id"), batch.column("held_out"), *arrays[1:]], names=names)

    def unmet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, log_p = vocabulary(model_path)[0], sent.value[1].tolist()
        seen: dict[bytes, float] = {END: 0.0}
        for batch in batches:
            values = []
            for w, x in zip(batch.column("new").to_pylist(), batch.column("log_p").to_pylist()):
                if w is not None and (x := seen.get(w)) is None:
                    if len(seen) > _FLUSH:
                        seen = {END: 0.0}
                    seen[w] = x = log_probability(w, pieces, log_p)
                values.append(x)
            columns = [*(batch.column(c) for c in ("rid", "k", "c")), pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["rid", "k", "c", "log_p"])

    first = kept(rows.withColumn("held_out", ~_is_training(held_out_of)).mapInArrow(read, schema))
    rare = first.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("rid", F.col("x.rare").alias("word"), F.col("x.times").alias("k"))
    uncommon = words.where(~((F.length("word") <= COMMON_BYTES) & (_level() >= level))) if common else words
    joined = rare.join(uncommon, "word", "left").select("rid", "k", F.coalesce("c", F.lit(0)).alias("c"), "log_p", F.when(F.col("c").isNull(), F.col("word")).alias("new"))
    rest = joined.mapInArrow(unmet, "rid long, k int, c long, log_p double").groupBy("rid").agg(
        F.sum(F.col("k") * F.log10(F.col("c") + 0.1)).alias("base_rest"),
        F.sum(F.col("k") * F.col("log_p")).alias("score_rest"),
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("more"),
    )
    both = first.drop("rare", "times").join(rest, "rid", "left")
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base_part") + F.coalesce("base_rest", F.lit(0.0)) - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        ((F.col("score_part") + F.coalesce("score_rest", F.lit(0.0))) / F.lit(math.log(10))).alias("score"),
    )
