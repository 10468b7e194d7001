"""Importance resampling, exact search and spelling variants against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import importance, spelling, top_products

# --- importance resampling ---


def drawn_plainly(docs, target, most=1, n=50, percent=10, least=20):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return [zlib.crc32(" ".join(words[i : i + k]).encode()) % n for k in range(1, most + 1) for i in range(len(words) - k + 1)], len(words)

    s, t = (Counter(b for text in texts for b in features(text)[0]) for texts in ([d[1] for d in docs], target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + n) / ((s[b] + 1) * (t.total() + n)))) for b in range(n)]
    rows = []
    for i, text in docs:
        found, words = features(text)
        weight = math.floor(sum(gain[b] for b in found) / len(found)) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    ranked = Counter((*r, place if place <= percent * len(fit) // 100 else None) for place, r in enumerate(fit, 1))
    return ranked + Counter((*r, None) for r in rows if r[1] < least)


@pytest.mark.parametrize("most", [1, 2])
def test_resampling_equals_plain(spark, most):
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma3", "é", "δ", "x'y", "z", "10"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.choice((0, 3, 25, 60))))) for i in range(-40, 160)]
    docs += [(7, docs[60][1])] * 30 + [(None, "alpha " * 25), (None, None), (500, "\x00\x7f -- "), (501, "beta " * 40_000)]
    target = ["alpha beta", None, "", "é é 10"]
    got = importance.resampled(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), most=most, n_buckets=50, percent=40)
    assert Counter(tuple(r) for r in got.collect()) == drawn_plainly(docs, target, most, percent=40)


def test_resampling_cuts_ties_by_identifier(spark, monkeypatch):
    monkeypatch.setattr(importance, "noise", lambda seed: F.lit(0).cast("long"))
    docs = spark.range(0, 3000, 1, 7).select((F.col("id") * 7919 % 3000 - 1500).alias("doc_id"), F.lit("same words " * 10).alias("text"))
    got = importance.resampled(docs, spark.createDataFrame([("other",)], "text string"), percent=33).where("rank is not null")
    assert sorted((r["rank"], r["doc_id"]) for r in got.collect()) == [(i + 1, i - 1500) for i in range(990)]


def test_resampling_of_one_repeated_row(spark):
    docs = spark.range(2000).select(F.lit(3).cast("long").alias("doc_id"), F.lit("some words " * 12).alias("text"))
    got = importance.resampled(docs, docs, percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 1001)) and len(got) == 2000


def test_resampling_edges(spark):
    docs = spark.createDataFrame([(1, "a b", 1, 2), (2, None, 3, 4)], "doc_id long, text string, score long, place long")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["rank"] for r in importance.resampled(docs, none).collect()] == [None, None]
    empty = spark.createDataFrame([], docs.schema)
    assert importance.resampled(empty, docs).count() == 0
    assert importance.resampled(docs.withColumnsRenamed({"doc_id": "row", "text": "n words"}), docs.withColumnRenamed("text", "n words"), "row", "n words").count() == 2


def test_highest_bound_finds_every_place(spark):
    values = sorted(random.Random(1).choices(range(-50, 10_000), k=300), reverse=True)
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for wanted in (1, 2, 150, 299, 300):
        assert importance.highest_bound(df, F.col("v"), wanted) == values[wanted - 1]


# --- exact search ---


def top_plainly(rows, k, every=50):
    whole = []
    for place, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v):
            whole.append((place, i, [math.floor(256 * x) for x in v]))
    out = Counter()
    for place, i, q in whole:
        if i is None or i % every:
            continue
        found = [(-sum(a * b for a, b in zip(q, c)), j is None, j or 0, j) for other, j, c in whole if other != place]
        out.update((i, rank, f[3], max(-(1 << 63), min((1 << 63) - 1, -f[0]))) for rank, f in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1))
    return out


def searched(spark, rows, k=5, parts=4, every=50):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")).withColumn("row", F.lit(0))
    return Counter(tuple(r) for r in top_products.top_products(df.repartition(parts), F.col("vec_id") % every == 0, k).collect())


def vectors(rng, n, width, spread):
    scale = np.exp(rng.normal(0, spread, (n, 1))) * np.linspace(2, 0.05, width)
    return (rng.normal(0, 0.2, (n, width)) * scale).tolist()


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_search_equals_plain(spark, monkeypatch, spread):
    monkeypatch.setattr(top_products, "SLOT_BYTES", 4096)
    monkeypatch.setattr(top_products, "BLOCK_BYTES", 1024)
    monkeypatch.setattr(top_products, "RUN", 16)
    rows = list(enumerate(vectors(np.random.default_rng(5), 1200, 12, spread)))
    assert searched(spark, rows) == top_plainly(rows, 5)


def test_search_edges(spark):
    rng = np.random.default_rng(6)
    rows = list(enumerate(vectors(rng, 150, 6, 0.5)))
    rows += [(i, [1.0, 1.0, 0.5, 0.0, 0.0, 0.0]) for i in range(150, 400)]  # many equal ones: ties go to smaller identifiers
    rows += [(450, None), (451, [1.0, None]), (452, [float("nan")] * 6), (453, [float("inf")]), (454, [1e308] * 6), (500, [0.0] * 6), (550, []), (551, [3.0]), (None, [1.0] * 6), (None, [0.5] * 8), (600, [-2.0] * 6)]
    assert searched(spark, rows) == top_plainly(rows, 5)
    assert searched(spark, rows, k=3, parts=1) == top_plainly(rows, 3)
    assert searched(spark, [(50, [1.0]), (50, [1.0]), (50, [1.0])], k=2) == Counter({(50, 1, 50, 65536): 3, (50, 2, 50, 65536): 3})
    assert searched(spark, [(50, [1.0])]) == Counter() and searched(spark, [(1, [1.0])]) == Counter()
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_products.top_products(empty, F.col("vec_id") % 50 == 0, 5).count() == 0


def test_search_beyond_doubles(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(1 << 30)) for _ in range(3)]) for i in range(120)]
    rows += [(200, [1e150, 1.0]), (201, [2e150, 2.0]), (202, [-1e200])]
    assert searched(spark, rows) == top_plainly(rows, 5)


def test_bounds_leave_slots_out(spark, monkeypatch):
    monkeypatch.setattr(top_products, "SLOT_BYTES", 4096)
    met, plain = spark.sparkContext.accumulator(0), top_products.search

    def search(queries, slot, turn, k):
        met.add(len(slot) * len(queries))
        return plain(queries, slot, turn, k)

    monkeypatch.setattr(top_products, "search", search)
    rows = [(i, [float(2000 - i)]) for i in range(2000)]
    assert searched(spark, rows, parts=1, every=500) == top_plainly(rows, 5, 500)
    assert 0 < met.value < 2000 * 4


# --- spelling variants ---


def variants_plainly(docs, least_length=6, least_count=5, ratio=5, thinned=199):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            counts[word[: h % len(word)] + word[h % len(word) + 1 :] if h % thinned == 0 else word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    rows = {}
    for w, n in words.items():
        found = sorted((-m, o) for o, m in words.items() if near(w, o))
        form = found[0][1] if found and -found[0][0] >= ratio * n else None
        rows[w] = (form, n, len(found), -found[0][0] if form else None)
    out = set()
    for w, (form, *rest) in rows.items():
        root = w
        while rows[root][0]:
            root = rows[root][0]
        out.add((w, form, root, *rest))
    return out


def variants(spark, docs, **more):
    return {tuple(r) for r in spelling.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2)), **more).collect()}


def test_variants_equal_plain(spark):
    rng, docs = random.Random(9), []
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randrange(6, 10))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "ababab", "bababa", "ÀBcdefÿ", "àbcdefÿ"]
    words = []
    for stem in stems:
        for n in (400, 60, 9, 2):
            words += [stem] * n
            at = rng.randrange(len(stem))
            stem = stem[:at] + rng.choice(("", "x", stem[at] + "b", "É")) + stem[at + 1 :]
    rng.shuffle(words)
    docs = [(i, rng.choice((" ", "\n", "-", "7", "’")).join(words[i * 40 : i * 40 + 40])) for i in range(len(words) // 40)]
    docs += [(None, "hellooo " * 7), (None, None), (3, ""), (3, "hellooó " * 300)]
    expected = variants_plainly(docs)
    assert variants(spark, docs) == expected and len({r[2] for r in expected if r[1] and r[2] != r[1]}) > 3
    assert variants(spark, docs, thinned=7, least_length=4) == variants_plainly(docs, thinned=7, least_length=4)


def test_pivots_find_every_pair_one_edit_apart(spark):
    rng = random.Random(4)
    words = list({"".join(rng.choice("ab") for _ in range(rng.randrange(4, 9))) for _ in range(400)})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = {(r.word, r.other) for r in spelling.near_words(df).collect()}

    def deletions(w):
        return {(i, w[:i] + w[i + 1 :]) for i in range(len(w))}

    cut = {w: deletions(w) for w in words}
    expected = {(a, b) for a in words for b in words if a != b and (cut[a] & cut[b] if len(a) == len(b) else any(c == b for _, c in cut[a]) or any(c == a for _, c in cut[b]))}
    assert got == expected


def test_variants_edges(spark):
    assert variants(spark, []) == set() and variants(spark, [(1, None), (2, "short words only")]) == set()
    with pytest.raises(ValueError):
        spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string"), least_length=3)
    long = [(1, "lettered " * 200_000 + "letteredd " * 5)]
    assert variants(spark, long, thinned=0) == {("lettered", None, "lettered", 200_000, 1, None), ("letteredd", "lettered", "lettered", 5, 1, 200_000)}
