"""Secrets, quality rules, packing and benchmark seeds against plain Python; SQL forms of the queries; the pipeline."""

from __future__ import annotations

import base64
import bisect
import gzip
import itertools
import os
import random
import re
import time
import urllib.parse
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from oracle import connect, difference
from tickloom.llm import packing, repetition, secret_scan, spaced_seeds
from tickloom.llm.queries import ORACLE_SQL, QUERIES

BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
SECRET = "password=hunter2secret"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_small, name):
    assert difference(QUERIES[name](spark, sf_small), connect(sf_small), ORACLE_SQL[name]) is None


def added(text):
    return [(start, secret_scan.KINDS[kind], end, way) for start, kind, end, way in secret_scan.scan(text)[1]]


def b64(raw):
    return base64.b64encode(raw).decode()


@pytest.mark.parametrize(
    "hidden, way",
    [
        (b64(SECRET.encode()), "base64"),
        (b64(zlib.compress(SECRET.encode())), "base64>zlib"),
        (b64(gzip.compress(zlib.compress(SECRET.encode()))), "base64>zlib>zlib"),
        (b64(b64(SECRET.encode()).encode()), "base64>base64"),
        ("".join(f"%{b:02x}" for b in SECRET.encode()), "url"),
        (urllib.parse.quote(urllib.parse.quote("password=hu/nter2secret")), "url>url"),
        ("".join(f"\\u{ord(c):04x}" for c in SECRET), "unicode"),
        ("".join(f"\\x{ord(c):02x}" for c in SECRET), "unicode"),
        (b64("".join(f"%{b:02x}" for b in SECRET.encode()).encode()), "base64>url"),
    ],
)
def test_layers(hidden, way):
    text = f"é before {hidden} after"
    found = added(text)
    assert found and all(kind == "assign" for _, kind, _, _ in found) and any(w == way for *_, w in found)
    for start, _, end, _ in found:
        assert 9 <= start < end <= 9 + len(hidden)


def test_partly_encoded_secret_maps_to_its_characters():
    text = "x t%6Fken%3Dabcd%2Bef12 y"
    assert added(text) == [(2, "assign", 23, "url")]
    assert added("nothing to see: 100% of it, c:\\users\\x, thanonontioninerthanon") == []


def test_cycles_end():
    assert secret_scan.scan("%25" * 50 + "%2541") == ([], [])


@pytest.mark.parametrize("pack", [zlib.compress, gzip.compress, lambda raw: gzip.compress(raw[:4000]) + gzip.compress(raw[4000:]), lambda raw: zlib.compress(gzip.compress(raw))])
@pytest.mark.parametrize("at", [0, 900, 2990, 7000, 7960])
def test_layers_larger_than_a_window_are_read_whole(monkeypatch, pack, at):
    monkeypatch.setattr(secret_scan, "WINDOW", 1000)
    monkeypatch.setattr(secret_scan, "OVERLAP", 100)
    raw = bytearray(b"x " * 4000)
    raw[at : at + 24] = b" password=hunter2secret "
    hidden = b64(pack(bytes(raw)))
    assert {kind for _, kind, _, _ in added(f"a {hidden} b")} == {"assign"}


def test_a_layer_far_larger_than_its_text():
    raw = b"\0" * (100 << 20) + b" password=hunter2secret " + b"\0" * (20 << 20)
    assert [x[1] for x in added("a " + b64(zlib.compress(raw)))] == ["assign"]


def test_long_prose_takes_time_in_proportion():
    words = " ".join(f"Donaudampfschifffahrtsgesellschaft{i % 13}" for i in range(4000))
    took = []
    for times in (1, 8):
        start = time.perf_counter()
        secret_scan.scan(" ".join([words] * times))
        took.append(time.perf_counter() - start)
    assert took[1] < 24 * took[0]


SPACED = ["x" + " " * 1_000_000 + "y", "x" + "\n" * 1_000_000 + "y", " \n\t" * 400_000 + "z", " " * packing.LONG_SPACE + "\n", "a\u3000" + " " * packing.LONG_SPACE + "'s", "a" + "\n" * packing.LONG_SPACE + " b" + " " * packing.LONG_SPACE]


def test_ids_of_long_white_space():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text, ids in zip(SPACED, packing.token_ids(SPACED, BPE)):
        assert ids == plain.encode(text, add_special_tokens=False).ids


def test_packing_and_the_last_stage_take_long_white_space(spark, sf_small):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(SPACED[:2])], "doc_id long, text string")
    for out in (packing.packed(docs, BPE), corpus_pipeline.best_fit_packing(spark, docs, sf_small)):
        assert {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == {0: 1_000_002, 1: 500_004}


@given(st.lists(st.integers(1, 12), max_size=60))
@settings(max_examples=200, deadline=None)
def test_sum_of_squares_equals_plain_rule(lengths):
    """Every piece goes where the sum of squared counts of open sequences per gap becomes smallest, if any has room."""
    gaps: dict[int, int] = {}  # gap of each sequence

    def squares(state):
        counts = [0] * 13
        for gap in state.values():
            counts[gap] += 1
        return sum(c * c for c in counts[1:])

    bins, offsets = packing.sum_of_squares(np.array(lengths, np.int64), 12)
    for n, number, offset in zip(lengths, bins.tolist(), offsets.tolist()):
        room = {gap for gap in gaps.values() if gap >= n}
        if not room:
            assert number not in gaps and offset == 0
            gaps[number] = 12 - n
            continue
        assert offset == 12 - gaps[number]
        after = {gap: squares({**gaps, next(k for k, g in gaps.items() if g == gap): gap - n}) for gap in room}
        assert after[gaps[number]] == min(after.values())
        gaps[number] -= n


def test_benchmark_items_of_any_length(spark):
    rng, items, docs = random.Random(8), [], []
    for n in range(1, 20):
        for _ in range(3):
            item = [f"b{rng.randrange(10**6)}" for _ in range(n)]
            items.append((len(items), " ".join(item)))
            for changed in range(4):
                copy = list(item)
                for k in rng.sample(range(n), min(changed, n)):
                    copy[k] = "other"
                around = [f"d{rng.randrange(10**6)}" for _ in range(rng.randrange(12))]
                docs.append((len(docs), " ".join(around + copy + around[:3])))
    docs += [(len(docs), ""), (len(docs) + 1, None)]
    con = duckdb.connect()
    for name, rows, key in (("documents", docs, "doc_id"), ("benchmark", items, "item_id")):
        frame = pd.DataFrame(rows, columns=[key, "text"])  # noqa: F841
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM frame")
    found = spaced_seeds.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert difference(found.withColumn("item_ids", F.array_join("item_ids", ",")), con, ORACLE_SQL["op9_benchmark_decontamination"]) is None
    hit = {r.doc_id for r in found.where("contaminated").collect()}
    assert {d for d in range(0, 4 * len(items), 4)} <= hit and not {4 * i + 1 for i in range(15)} & hit


def test_base_spans(spark):
    text = 'API_KEY: "abcdef123" token = ab12 Secret:"x.y-z_9=" AKIA' + "A1" * 8 + " AKIAXX 0123456789abcdef01234567 ABC"
    plain = []
    for kind, pattern in (("assign", secret_scan.ASSIGN), ("access", re.compile("AKIA[A-Z0-9]+")), ("hex", re.compile("[0-9a-f]+"))):
        for m in pattern.finditer(text):
            if len(m[2] if kind == "assign" else m[0]) >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                plain.append((m.start(), secret_scan.KINDS.index(kind), m.end()))
    assert secret_scan.find(text) == sorted(plain) and len(plain) == 4
    row = secret_scan.secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_assign, row.n_access, row.n_hex, row.n_added) == (2, 1, 1, 0) and row.spans == row.base_spans


def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    threes = list(zip(words, words[1:], words[2:]))
    inside = {i + k for i, w in enumerate(threes) if threes.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed


def longest_repeats(numbers, least):
    n, inside, longest = len(numbers), set(), 0
    for i, j in itertools.permutations(range(n), 2):
        k = 0
        while max(i, j) + k < n and numbers[i + k] == numbers[j + k]:
            k += 1
        if k >= least:
            inside.update(range(i, i + k))
            longest = max(longest, k)
    return inside, longest


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(0, 2), max_size=30), st.integers(2, 6))
def test_repeats_equal_brute_force(numbers, least):
    array = np.array(numbers, np.int64)
    inside, longest = longest_repeats(numbers, least)
    got, length, _ = repetition.repeat_spans(array, least)
    assert set(np.flatnonzero(got).tolist()) == inside and length == longest
    spans = repetition.maximal_repeats(array, least) if numbers else []
    assert {s + k for n, starts in spans for s in starts for k in range(n)} == inside


def test_quality(spark, sf_small):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    small = {i: t for i, t in rows.items() if len(t) < 6000}
    for r in QUERIES["op6_quality_rules"](spark, sf_small).collect():
        if r.doc_id in small:
            want = plain_quality(small[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want and not (r.kept and r.base_failed)
    fresh = " ".join(f"n{i}" for i in range(100))
    block = " ".join(f"b{i}" for i in range(40))
    assert repetition.measure(fresh)[-1]
    # 80 of 180 words repeat, not enough for the base rule.
    assert repetition.measure(f"{block} {fresh} {block}")[4:] == (80, False, 80, 40, 2, "0:40,140:180", False)


def pieces_of(ids):
    first = len(ids) % 1024
    cuts = ([ids[:first]] if first else []) + [ids[i : i + 1024] for i in range(first, len(ids), 1024)]
    return [(len(c), zlib.crc32(np.asarray(c, "<u4").tobytes())) for c in cuts]


def test_packing_holds_every_token(spark, sf_small):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op7_best_fit_packing"](spark, sf_small).toPandas().sort_values(["doc_id", "piece"])
    for r in docs:
        mine = got[got.doc_id == r.doc_id]
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        assert list(zip(mine.length, mine.ids_crc32)) == pieces_of(ids) and mine.piece.tolist() == list(range(len(mine)))
        assert mine.start.tolist() == np.cumsum([0, *mine.length[:-1]]).tolist()
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == np.cumsum([0, *s.length[:-1]]).tolist() and s.length.sum() <= 1024
    assert got.sequence_id.nunique() <= 1.02 * -(-got.length.sum() // 1024) + 2


@settings(deadline=None, max_examples=300)
@given(st.text(max_size=60))
def test_rank_file_gives_the_ids_of_the_tokenizers_file(text):
    from tokenizers import Tokenizer

    tokenizer = _TOKENIZER.get("made") or _TOKENIZER.setdefault("made", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    assert packing.token_ids([text], BPE) == [tokenizer.encode(text, add_special_tokens=False).ids]


_TOKENIZER: dict = {}


def test_special_token_in_a_text():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "a <|endoftext|> b\n\n  c"
    assert packing.token_ids([text], BPE) == [tokenizer.encode(text, add_special_tokens=False).ids]


def test_packing_fills_sequences():
    lengths = np.sort(np.random.default_rng(0).integers(1, 1024, 3000))[::-1]
    bins, offsets = packing.sum_of_squares(lengths)
    used = np.bincount(bins, weights=lengths)
    gaps: list[int] = []  # plain best fit, longest first
    for n in lengths.tolist():
        at = bisect.bisect_left(gaps, n)
        gap = gaps.pop(at) if at < len(gaps) else 1024
        bisect.insort(gaps, gap - n)
    assert used.max() <= 1024 and len(used) <= 1.01 * len(gaps)
    for b in range(len(used)):
        at = np.argsort(offsets[bins == b])
        assert (offsets[bins == b][at] == np.concatenate(([0], np.cumsum(lengths[bins == b][at])[:-1]))).all()


def test_masks_find_every_window_with_three_substitutions():
    for gone in itertools.combinations(range(spaced_seeds.WINDOW), spaced_seeds.WINDOW - spaced_seeds.MATCHES):
        places = [{i + m for m in mask} for mask in spaced_seeds.MASKS for i in range(spaced_seeds.WINDOW - max(mask))]
        assert any(not p & set(gone) for p in places)
    for n, run in spaced_seeds.SHORT_RUNS.items():
        for gone in itertools.combinations(range(n), n - spaced_seeds.short_need(n)):
            assert any(not set(range(i, i + run)) & set(gone) for i in range(n - run + 1))


@pytest.mark.parametrize("block_words", [500_000, 300])
def test_substituted_items_are_found(spark, monkeypatch, block_words):
    monkeypatch.setattr(spaced_seeds, "BLOCK_WORDS", block_words)
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, [word() for _ in range(n)]) for i, n in enumerate([5, 8, 9, 11, 13, 15, 16, 17, 30, 60] * 4)]
    docs, want = [], {}
    for d in range(160):
        i, words = rng.choice(items)
        copy = list(words)
        for at in rng.sample(range(len(copy)), min(len(copy), rng.randrange(6))):
            copy[at] = "x" + word()
        n, w = len(words), min(len(words), 16)
        equal = [a == b for a, b in zip(words, copy)]
        need = 13 if n >= 16 else spaced_seeds.short_need(n)
        best = max(sum(equal[s : s + w]) for s in range(n - w + 1))
        docs.append((d, " ".join([word() for _ in range(rng.randrange(40))] + copy + [word() for _ in range(rng.randrange(40))])))
        want[d] = (str(i), best) if n >= 8 and best >= need else ("", 0)
    benchmark = spark.createDataFrame([(i, " ".join(w).upper() + ".") for i, w in items], "item_id long, text string")
    got = spaced_seeds.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    assert {r.doc_id: (",".join(map(str, r.item_ids)), r.best_equal) for r in got} == want
    assert len(spaced_seeds.without_benchmark(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()) == sum(w == ("", 0) for w in want.values())


def test_pipeline_equals_plain_steps(spark, sf_small):
    """The stages once more in plain Python, but for the exact methods that other tests hold against brute force."""
    from tickloom.llm import ngram_join
    from test_llm_dedup import shingles

    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    kept = {i: t for i, t in rows.items() if repetition.measure(t or "")[-1]}
    seen, texts = set(), {}
    for i in sorted(kept):
        lines = kept[i].split("\n")
        real = [k for k, x in enumerate(lines) if x.strip(" \t\n\r\x0b\x0c")]
        gone = set()
        for at in range(len(real) - 2):
            window = tuple(lines[k] for k in real[at : at + 3])
            gone.update(real[at : at + 3] if window in seen else ())
            seen.add(window)
        if not gone or set(real) - gone:
            texts[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}
    for i, j in itertools.combinations(sorted(sets), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            old, new = max(root[i], root[j]), min(root[i], root[j])
            root = {k: new if r == old else r for k, r in root.items()}
    single = {i: t for i, t in texts.items() if root[i] == i}
    docs = spark.createDataFrame(list(single.items()), "doc_id long, text string")
    clean = {r.doc_id for r in spaced_seeds.contaminated(docs, spark.read.parquet(f"{sf_small}/benchmark.parquet")).where("not contaminated").collect()}
    out = corpus_pipeline.run(spark, sf_small).toPandas()
    assert set(out.doc_id) == clean and ngram_join.SHINGLE == 5
    for i, mine in out.sort_values("piece").groupby("doc_id"):
        ids = packing.token_ids([single[i]], BPE)[0] + [2]
        assert list(zip(mine.length, mine.ids_crc32)) == pieces_of(ids)


def test_entry_registers_all():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert os.path.exists(corpus_pipeline.__file__) and "pipeline" not in entry.oracle_sql()
