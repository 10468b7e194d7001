"""Near duplicates, repeated byte strings and repeated lines against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import line_windows, ngram_join, suffix_buckets
from tickloom.llm.components import components


def words(rng, n, vocabulary=400):
    return [f"v{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Families of edited copies, passages that many documents share, short documents and exact copies."""
    rng = random.Random(7)
    passage, texts = " ".join(words(rng, 60)), []
    for size in (5, 6, 7, 8, 9, 12, 20, 40, 90, 200):
        for _ in range(2):
            base = words(rng, size)
            for _ in range(6):
                copy = list(base)
                for _ in range(rng.randrange(max(2, size // 20) + 1)):
                    at = rng.randrange(len(copy))
                    copy[at : at + 1] = rng.choice(([], words(rng, 1), copy[at : at + 1] + words(rng, 1)))
                texts.append(" ".join(copy))
    for _ in range(25):
        mine = words(rng, rng.choice((8, 15, 60)))
        at = rng.randrange(len(mine))
        texts.append(" ".join(mine[:at]) + " " + passage + " " + " ".join(mine[at:]))
    texts += texts[:5] + ["", "one two", "One\ttwo", "a b c d", "A B C D e"]
    return list(enumerate(texts))


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} if len(found) > 4 else {tuple(found)} if found else set()


def test_components_equal_brute_force(spark, corpus):
    sets, root = [shingles(t) for _, t in corpus], list(range(len(corpus)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    got = ngram_join.near_duplicates(spark.createDataFrame(corpus, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, len(sets[i]), root[i]) for i in range(len(corpus))}
    kept = ngram_join.without_near_duplicates(spark.createDataFrame(corpus, "doc_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == {i for i in range(len(corpus)) if root[i] == i}


def test_linked_sets_agree_on_enough_signatures():
    rng, linked = np.random.default_rng(3), 0
    for _ in range(4000):
        n = int(rng.choice([3, 4, 5, 6, 8, 10, 11, 13, 14, 20, 35, 47, 50, 80, 300]))
        universe = ngram_join.mix(rng.integers(1, 2**62, 2 * n + 8).astype(np.uint64))
        cut, more = rng.integers(0, n // 3 + 2, 2)
        a, b = np.unique(universe[:n]), np.unique(np.concatenate((universe[cut:n], universe[n : n + more])))
        both = len(np.intersect1d(a, b))
        if not np.array_equal(a, b) and 100 * both >= 75 * (len(a) + len(b) - both):
            linked += 1
            ours, theirs = ({parity: (need, sigs) for parity, need, sigs in ngram_join.signatures(x)} for x in (a, b))
            for parity in ours.keys() & theirs.keys():
                agree = len(np.intersect1d(ours[parity][1], theirs[parity][1]))
                assert agree >= ours[parity][0] and agree >= theirs[parity][0]
            assert ours.keys() & theirs.keys()
            odd = np.bitwise_count(ngram_join.sketch(a).view(np.uint64) ^ ngram_join.sketch(b).view(np.uint64)).sum()
            assert odd <= ngram_join.most_different(len(a), len(b))
    assert linked > 500


def test_shared_signatures_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rng = random.Random(1)
        rows = [(rng.randrange(12), rng.randrange(6)) for _ in range(120)] + [(50, 1), (51, 1), (51, 1), (52, 1), (52, 2)] + [(60, i) for i in range(40)]
        got = ngram_join.shared(spark.createDataFrame(rows, "sig long, f long"), most_held=10).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    members = {s: {f for g, f in rows if g == s} for s, _ in rows}
    assert {(r.sig, r.f, r.cost) for r in got} == {(s, f, len(m) if s < 60 else ngram_join.HOT) for s, m in members.items() for f in m if len(m) > 1}
    assert len(got) == sum(len(m) for m in members.values() if len(m) > 1)


def joined(spark, monkeypatch, texts):
    """Components by brute force and by the join, and the number of pairs that it verified."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    holders = {}
    for i, a in enumerate(sets):
        for x in a:
            holders.setdefault(x, []).append(i)
    seen = Counter()
    for rows in holders.values():
        if len(rows) < 500:  # linked documents of these tests share rarer shingles too
            seen.update((j, i) for k, i in enumerate(rows) for j in rows[:k])
    for j, i in seen:
        both = len(sets[i] & sets[j])
        if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            old, new = max(root[i], root[j]), min(root[i], root[j])
            root = [new if r == old else r for r in root]
    pairs, plain = [], ngram_join.linked
    monkeypatch.setattr(ngram_join, "linked", lambda p, s: pairs.append(p.count()) or plain(p, s))
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    return dict(enumerate(root)), got, sum(pairs)


def test_a_passage_in_many_documents_makes_few_pairs(spark, monkeypatch):
    rng = random.Random(11)
    passage = " ".join(words(rng, 60, 10**6))
    texts = [" ".join(words(rng, 60, 10**6)) + f" {passage} " + " ".join(words(rng, rng.randrange(20), 10**6)) for _ in range(2000)]
    texts += [t + " more" for t in texts[:50]]
    want, got, pairs = joined(spark, monkeypatch, texts)
    assert got == want and len(set(want.values())) == 2000 and pairs < 500


def test_copies_near_the_threshold(spark, monkeypatch):
    """Copies of one text, many of which link with some and not with others."""
    rng, texts = random.Random(12), []
    base = words(rng, 150, 10**6)
    for i in range(300):
        copy = list(base)
        for _ in range(rng.randrange(1, 8)):
            copy[rng.randrange(len(copy))] = f"new{rng.random()}"
        texts.append(" ".join(copy[: len(copy) - rng.randrange(6)]))
    want, got, _ = joined(spark, monkeypatch, texts)
    assert got == want and 3 < len(set(want.values())) < 290


def test_a_group_of_near_copies_makes_few_pairs_for_each(spark, monkeypatch):
    """Copies that all link, none of which is known to link with another yet."""
    rng, n, texts = random.Random(13), 240, []
    base = words(rng, 200, 10**6)
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(1, 3)):
            copy[rng.randrange(len(copy))] = f"new{rng.random()}"
        texts.append(" ".join(copy).encode())
    found = {ngram_join.set_id(x): x for x in ngram_join.shingle_sets(texts)}
    rows = [(f, len(x), ngram_join.sketch(x).tolist(), x.view(np.int64).tolist()) for f, x in found.items()]
    sets = spark.createDataFrame(rows, "f long, n int, sketch array<long>, shingles array<long>").localCheckpoint()
    members = sets.selectExpr("f", "f AS root")
    pairs, plain = [], ngram_join.linked
    monkeypatch.setattr(ngram_join, "linked", lambda p, s: pairs.append(p.count()) or plain(p, s))
    roots = ngram_join.joined_roots(members, spark.createDataFrame([], "id long, root long"), sets)
    assert {(r.id, r.root) for r in roots.collect()} == {(f, min(found)) for f in found}
    assert sum(pairs) < n * (n - 1) / 2 / 4, pairs


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    random.Random(2).shuffle(edges)
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 300: 300, 301: 300}


def covered(texts):
    counts = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - 199):
            if counts[t[i : i + 200]] > 1:
                gone[i : i + 200] = [True] * 200
        out.append(gone)
    return out


def test_repeats_equal_brute_force(spark):
    rng = random.Random(5)
    noise = lambda n: bytes(rng.choice(b"abcdefgh \n") for _ in range(n)).decode()
    shared = [noise(n) for n in (199, 200, 201, 230, 450, 900)]
    texts = ["", "short", "z" * 199, "z" * 200, "z" * 450, "é" * 99 + "x", "é" * 120]
    for _ in range(40):
        parts = [noise(rng.randrange(160))]
        for _ in range(rng.randrange(4)):
            s = rng.choice(shared)
            a = rng.randrange(0, max(1, len(s) - 205))
            parts += [s[a : a + rng.randrange(190, 420)], noise(rng.randrange(1, 90))]
        texts.append("".join(parts))
    texts += texts[-3:]
    raw = [t.encode() for t in texts]
    got = {r.doc_id: r for r in suffix_buckets.without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, (t, gone) in enumerate(zip(raw, covered(raw))):
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not h for g, h in zip(gone, [False, *gone]))
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == (len(t), sum(gone), spans, kept), i


def test_repeats_of_given_documents(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    raw = [(r.text or "").encode() for r in rows]
    from tickloom.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op4_suffix_array_dedup"](spark, sf_small).collect()}
    for r, t, gone in zip(rows, raw, covered(raw)):
        assert got[r.doc_id].kept_sha256 == hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()


def test_line_windows(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\n\nc\ny"), (3, "b\nc\nd\ne"), (4, "a\nb"), (5, "s\ns\ns\ns\ns"), (1, "a\nb\nc\nd"), (6, None)]
    out = line_windows.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r.doc_id, r.text, r._n_lines, r._n_removed) for r in out if r.text is not None)
    assert got == [(1, "a\nb\nc\nd", 4, 0), (1, "a\nb\nc\nd", 4, 0), (2, "x\n\ny", 6, 3), (3, "e", 4, 3), (4, "a\nb", 2, 0), (5, "s", 5, 4)]
