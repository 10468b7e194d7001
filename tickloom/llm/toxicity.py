"""Toxicity of texts: gradient-boosted trees over a few dense features, with isotonic calibration.

The features are densities of lexicon words, how near they stand to a second person, capitals, punctuation and disguised
spellings. The lexicon has a fixed seed of insults and words learned from the training texts: those whose share among
toxic texts exceeds the one among others most clearly. The trees are fitted on two thirds of the training rows, and an
isotonic regression on the rest turns their margins into probabilities.

Learning uses at most ``SAMPLE`` labelled rows, those with the smallest hashes. Scoring is one pass over all texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import kept
from tickloom.llm.text import only, slices

SAMPLE, LEARNED, LEAST_TOXIC, LEAST_ODDS = 30_000, 200, 5, 1.0
THRESHOLD = 0.3
# Words of insult, second persons and the letters that other characters stand for.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers scum trash garbage pathetic disgusting worthless clown fool "
    "imbecile jerk creep freak pig vermin filth filthy hate kill die shut ugly liar coward dumbass asshole bastard bitch "
    "fuck fucking shit crap retard idiota estupido estupida imbecil basura asco idiote imbécile connard salope crétin "
    "dégoûtant dummkopf arschloch scheisse abschaum widerlich".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch sie tu te ti tus usted ustedes vosotros vous votre vos toi ton ta".split())
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t", "|": "l"})
_EDGES = ".,;:!?\"'()[]{}<>*#%&|-_~/\\`…“”‘’«»¡¿"
_STRETCHED = re.compile(r"(.)\1{2,}")
_NEAR = 5
FEATURES = (
    "words seed_hits seed_density learned_hits learned_density learned_weight top_weight near_second second_density capitals "
    "capital_words marks_density exclaimed symbols disguised disguised_hits stretched digits distinct"
).split()


def plain(word: str) -> tuple[str, bool]:
    """The word in lower case without marks around it, and whether its spelling was disguised."""
    low = word.lower().strip(_EDGES)
    if low.isalpha() or not low:
        if len(low) > 4 and (m := _STRETCHED.sub(r"\1", low)) != low:
            return m, True
        return low, False
    # Marks within a word, or characters for letters.
    letters = "".join(c for c in low.translate(DISGUISE) if c.isalpha())
    return (letters, True) if any(c.isalpha() for c in low) and letters != low else (low, False)


def features(text: str, learned: dict[str, float]) -> tuple[float, ...]:
    words = text.split()
    n = max(len(words), 1)
    seed, hit_at, weights, second, disguised, disguised_hits, stretched = 0, [], [], [], 0, 0, 0
    seen = set()
    for i, word in enumerate(words):
        low, odd = plain(word)
        seen.add(low)
        hit = low in INSULTS
        weight = learned.get(low, 0.0)
        if hit or weight:
            seed += hit
            hit_at.append(i)
            weights.append(weight)
            disguised_hits += odd
        elif low in SECOND_PERSON:
            second.append(i)
        disguised += odd
        stretched += odd and low.isalpha() and len(low) < len(word) - 1
    near, k = 0, 0
    for i in hit_at:
        while k < len(second) and second[k] < i - _NEAR:
            k += 1
        near += k < len(second) and second[k] <= i + _NEAR
    letters = sum(map(str.isalpha, text)) if not text.isascii() else len(text) - len(text.translate(_ASCII_LETTERS))
    upper = sum(map(str.isupper, text)) if not text.isascii() else len(text) - len(text.translate(_ASCII_UPPER))
    marks = len(text) - len(text.translate(_MARKS))
    symbols = len(text) - len(text.translate(_SYMBOLS))
    learned_hits = sum(w > 0 for w in weights)
    return (
        math.log1p(len(words)), seed, seed / n, learned_hits, learned_hits / n, sum(weights), max(weights, default=0.0), near, len(second) / n,
        upper / max(letters, 1), sum(w.isupper() and len(w) > 1 for w in words) / n, marks / n, text.count("!") / n, symbols / n, disguised / n,
        disguised_hits, stretched / n, sum(map(text.count, "0123456789")) / n, len(seen) / n,
    )


_ASCII_LETTERS = {i: None for i in (*range(65, 91), *range(97, 123))}
_ASCII_UPPER = {i: None for i in range(65, 91)}
_MARKS = {ord(c): None for c in ".,;:!?"}
_SYMBOLS = {ord(c): None for c in "#*$%&|<>"}


LEAST_ROWS = 20  # of a leaf of the trees


def _with_features(rows: DataFrame, learned: dict[str, float], carry: str) -> DataFrame:
    """The columns of ``carry`` (a schema) and the features, in place of the text."""
    names = [part.split()[0] for part in carry.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            cells = list(zip(*(features(t, learned) for t in batch.column("text").to_pylist())))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(c, pa.float64()) for c in cells)], names=[*names, *FEATURES])

    return rows.select(*names, "text").mapInArrow(run, carry + "".join(f", {f} double" for f in FEATURES))


def _distinct_words(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = [list({plain(w)[0] for w in t.split()} - {""}) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(words, pa.list_(pa.string()))], names=["label", "words"])

    return rows.select("label", "text").mapInArrow(run, "label double, words array<string>")


def learned_words(training: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """At most LEARNED words with the logarithm of their odds; ``training`` has ``label`` and ``text``."""
    counts = _distinct_words(training).select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("label").alias("in_toxic"), F.sum(1 - F.col("label")).alias("in_clean")
    )
    odds = F.log((F.col("in_toxic") + 0.5) / (toxic + 1) / ((F.col("in_clean") + 0.5) / (clean + 1)))
    # Doubtful differences do not count: the odds less two of their standard errors.
    sure = odds - 2 * F.sqrt(1 / (F.col("in_toxic") + 0.5) + 1 / (F.col("in_clean") + 0.5))
    best = counts.where(F.col("in_toxic") >= LEAST_TOXIC).select("word", odds.alias("odds"), sure.alias("sure")).where(F.col("sure") > LEAST_ODDS)
    return {r["word"]: r["odds"] for r in best.orderBy(F.desc("sure"), "word").limit(LEARNED).collect()}


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    ``labels`` has the identifier under the same name and a label of 0 or 1; rows held out, with a null in either column
    or without a text are not learned from, and of several labels for one identifier the largest counts. Without rows of
    both labels to learn from, every score is the share of label 1, or 0. Null and empty texts are scored like others;
    identifiers may be null or repeated; an empty table gives an empty one; other columns are not looked at.
    """
    rows = only(docs, id_col, text_col)
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("double").alias("label")).where("label in (0, 1)")
    known = known.where(F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("label").alias("label"))
    order = F.xxhash64("doc_id")
    taken = F.broadcast(known.orderBy(order, "doc_id").limit(sample))  # at most ``sample`` rows of two columns
    training = kept(rows.join(taken, "doc_id").dropDuplicates(["doc_id"]))
    counts = {r["label"]: r["count"] for r in training.groupBy("label").count().collect()}
    toxic, clean = counts.get(1.0, 0), counts.get(0.0, 0)
    kind = rows.schema["doc_id"].dataType.simpleString()
    if not toxic or not clean:
        score = F.lit(1.0 if toxic else 0.0)
        return rows.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))
    learned = learned_words(training, toxic, clean)
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    fit_on = kept(_with_features(training, learned, f"doc_id {kind}, label double"))
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(3))
    first, rest = fit_on.where(part > 0), fit_on.where(part == 0)
    if first.select("label").distinct().count() < 2 or rest.isEmpty():
        first = rest = fit_on
    trees = GBTClassifier(labelCol="label", maxIter=20, maxDepth=4, stepSize=0.2, minInstancesPerNode=LEAST_ROWS, seed=1, cacheNodeIds=False)
    model = trees.fit(assemble.transform(first).select("label", "features"))
    margin = vector_to_array("rawPrediction")[1]
    calibration = model.transform(assemble.transform(rest)).select("label", margin.alias("margin"))
    isotonic = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(calibration)
    scored = model.transform(assemble.transform(_with_features(rows.withColumn("held_out", held_out()), learned, f"doc_id {kind}, held_out boolean")))
    scored = isotonic.transform(scored.select("doc_id", "held_out", margin.alias("margin")))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
