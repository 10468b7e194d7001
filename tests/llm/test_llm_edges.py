"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import importance, license_scan, line_windows, ngram_join, packing, repetition, secret_scan, spaced_seeds, subword_lattice, suffix_buckets, toxicity

BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
PROSE = " ".join(f"w{i}" for i in range(80))
ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, PROSE), (4, PROSE), (5, PROSE), (None, PROSE + " more"), (None, None), (6, LONG), (7, "é" * 300), (7, "other text")]
SCHEMA = "doc_id long, text string, k1 string, k2 string, t long, f long, h long, n_words string, root long, sig long, score string, label string, held_out string, copies long, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", 1, 2, 3, "c", 4, 5, "d", "e", "f", 6, 7) for i, t in rows], SCHEMA)


def benchmark(spark, rows=((1, PROSE), (1, PROSE), (2, None), (3, ""), (None, "too short"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def labels(spark, rows=((4, 1), (5, 0), (6, 0), (None, 1), (1, None))):
    return spark.createDataFrame(list(rows), "doc_id long, toxic long")


PER_ROW = {
    "license": lambda s, d: license_scan.licenses(d),
    "toxicity": lambda s, d: toxicity.toxicity(d, labels(s)),
    "ngram": lambda s, d: ngram_join.near_duplicates(d),
    "suffix": lambda s, d: suffix_buckets.without_repeats(d),
    "secrets": lambda s, d: secret_scan.secrets(d),
    "repetition": lambda s, d: repetition.quality(d),
    "lines": lambda s, d: line_windows.without_repeated_lines(d),
    "seeds": lambda s, d: spaced_seeds.contaminated(d, benchmark(s)),
    "lattice": lambda s, d: subword_lattice.scored(d, PIECES),
    "importance": lambda s, d: importance.resampled(d, benchmark(s)),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_row(spark, name):
    out = PER_ROW[name](spark, table(spark, ROWS)).select("doc_id").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted((i is None, i or 0) for i, _ in ROWS)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, name):
    assert PER_ROW[name](spark, table(spark, []).repartition(2)).count() == 0


def test_packing_edges(spark):
    out = packing.packed(table(spark, ROWS), BPE).toPandas()
    assert len(out) >= len(ROWS) and (out[out.doc_id == 1].length == 1).all()
    assert packing.packed(table(spark, []), BPE).count() == 0


def test_empty_other_tables(spark):
    docs = table(spark, ROWS)
    assert spaced_seeds.contaminated(docs, benchmark(spark, [])).where("contaminated").count() == 0
    scores = toxicity.toxicity(docs, labels(spark, [])).select("score", "predicted").distinct().collect()
    assert [tuple(r) for r in scores] == [(0.0, 0)]


def test_stages_keep_columns_and_ends(spark, sf_small):
    docs = table(spark, ROWS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, table(spark, [])):
            out = stage(spark, rows, sf_small)
            assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
            out.collect()
    kept = corpus_pipeline.ngram_jaccard_join(spark, docs, sf_small)
    assert kept.where(F.col("text") == PROSE).count() == 1
    assert kept.where("text is null").count() == 2 and kept.where("doc_id = 7").count() == 2
    assert corpus_pipeline.quality_rules(spark, docs, sf_small).where("text is null or trim(text) = ''").count() == 0
    assert corpus_pipeline.benchmark_decontamination(spark, docs, sf_small).count() == len(ROWS)
    assert corpus_pipeline.line_dedup(spark, docs, sf_small).count() == len(ROWS)
