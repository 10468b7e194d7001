"""Language-model scores, toxicity and licences against plain Python and held-out rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tickloom.llm import license_scan, subword_lattice, toxicity
from tickloom.llm.queries import QUERIES

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def is_held_out(doc_id, of=10):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % of == 0


def segmentations(text, table):
    if not text:
        yield ()
    for j in range(1, len(text) + 1):
        if (piece := table.get(text[:j])) is None:
            return
        if piece >= 0:
            for rest in segmentations(text[j:], table):
                yield (piece, *rest)


def test_lattice_equals_all_segmentations():
    table, p = subword_lattice.vocabulary(PIECES)
    log_p, plain = np.log(p).tolist(), p.tolist()
    for word in ("the", "reading", "é", "ab!", "x�y"):
        ways = list(segmentations(b" " + word.encode(), table))
        shares = [math.prod(plain[k] for k in way) for way in ways]
        assert math.isclose(subword_lattice.log_probability(word.encode(), table, log_p), math.log(sum(shares)), rel_tol=1e-12)
        use, want = [0.0] * len(p), Counter()
        subword_lattice.expected_use(word.encode(), 3, table, plain, use)
        for way, share in zip(ways, shares):
            for k in way:
                want[k] += 3 * share / sum(shares)
        assert all(math.isclose(use[k], x, rel_tol=1e-9) for k, x in want.items()) and math.isclose(sum(use), sum(want.values()))


def test_expected_use_of_a_very_long_word():
    table, p = subword_lattice.vocabulary(PIECES)
    size = {k: len(piece) for piece, k in table.items() if k >= 0}
    use, word = [0.0] * len(p), b"abcdefgh\xff" * 2000
    subword_lattice.expected_use(word, 1, table, p.tolist(), use)
    assert math.isclose(sum(size[k] * x for k, x in enumerate(use) if x), len(word) + 1)


@pytest.mark.parametrize("common", [100_000, 50, 0])
def test_scores_equal_brute_force(spark, sf_small, monkeypatch, common):
    monkeypatch.setattr(subword_lattice, "COMMON", common)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(20).cache()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    counts = Counter()
    for doc_id, text in rows:
        if not is_held_out(doc_id):
            counts.update([*split(text), ""])
    n, v = sum(counts.values()), len(counts)
    table, start = subword_lattice.vocabulary(PIECES)
    p = start
    for _ in range(subword_lattice.ROUNDS):
        use = [0.0] * len(p)
        for w, c in counts.items():
            if w:
                subword_lattice.expected_use(w.encode(), c, table, p.tolist(), use)
        use[0] = counts[""]
        p = (np.array(use) + subword_lattice.PRIOR * start) / (sum(use) + subword_lattice.PRIOR)
    log_p = np.log(p).tolist()
    got = {r.doc_id: r for r in subword_lattice.scored(docs, PIECES).collect()}
    for doc_id, text in rows:
        tokens, r = split(text), got[doc_id]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*tokens, ""])
        score = (sum(subword_lattice.log_probability(w.encode(), table, log_p) for w in tokens) + log_p[0]) / math.log(10)
        known = sum(counts[w] > 0 for w in [*tokens, ""])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (is_held_out(doc_id), len(tokens) + 1, known, n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"  # about 3,000 rows to learn from; with the 300 of sf0.01 the figure is 0.87
    got = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(got[i].score, y) for i, y in labels.items() if i in got and got[i].held_out]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in held for b, y in held if x == 1 and y == 0]
    assert len(held) > 50 and sum(pairs) / len(pairs) > 0.9


def test_disguised_words():
    assert [toxicity.plain(w)[0] for w in ("Idiot!", "1d10t", "m.o.r.o.n", "stuuuupid", "l0$er,", "don't", "***")] == ["idiot", "idiot", "moron", "stupid", "loser", "dont", ""]
    cells = dict(zip(toxicity.FEATURES, toxicity.features("You are an 1D10T and YOU know it!", {})))
    assert cells["seed_hits"] == 1 and cells["near_second"] == 1 and cells["disguised_hits"] == 1 and cells["exclaimed"] > 0


def test_licences(spark):
    prose = "the quick brown fox jumps over the lazy dog and may not use this or that in the end of the day"
    rows = [(1, prose), (2, f"{prose}\nLicensed under the Apache License, Version 2.0."), (3, "licensed under cc by-nc 4.0\n\nReleased under the MIT license"), (4, None)]
    rows += [(10 + i, f"{prose} {i} and some more words about nothing at all") for i in range(40)]
    got = {r.doc_id: r for r in license_scan.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].families, got[2].families, got[3].families, got[4].families) == ("", "apache", "cc-by-nc,mit", "")
    assert got[2].spans == f"apache:{len(prose) + 1}:{len(prose) + 48}" and got[3].n_paragraphs == 2 and got[4].n_paragraphs == 0


def test_licences_of_given_documents(spark, sf_small):
    """The four notices that the given documents hold, found by plain comparison."""
    lines = {
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "Licensed under the Apache License, Version 2.0.": "apache",
        "Released under the MIT License.": "mit",
    }
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for r in QUERIES["op1_license_scan"](spark, sf_small).collect():
        assert r.families == ",".join(sorted({lines[x] for x in texts[r.doc_id].split("\n") if x in lines}))
