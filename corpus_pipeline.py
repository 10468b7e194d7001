"""A training corpus from raw documents, in five stages of this library's text operators.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each stage's result as Parquet and gives
the next stage what it reads back. All but the last keep the columns of ``documents``.

1. quality rules: documents that fail a rule go.
2. line deduplication: later occurrences of three-line windows go from the texts; a document of which no line with a word
   is left goes too. ``n_chars`` is the length of the text that is left.
3. n-gram Jaccard join: of documents that links connect, the one with the smallest identifier stays. Where rows share
   that identifier, the one with the smallest text stays; documents without words link with nothing and stay.
4. benchmark decontamination: documents that overlap an item of ``benchmark`` go.
5. best-fit packing: the token pieces of what is left and their places in sequences.

Null and empty texts fail the quality rules, so that stages two to five see none in a run; by themselves they keep them
(stage 2 to 4) or pack the end id alone (stage 5). Repeated rows are linked by their equal texts, and one stays. Null
identifiers are kept and count as larger than all others. Other columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import line_windows, ngram_join, packing, repetition, spaced_seeds
from tickloom.llm.store import kept
from tickloom.llm.text import text_of
from tickloom.sources.scratch import new_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repetition.good_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_windows.without_repeated_lines(docs)
    changed = F.col("_n_removed") > 0
    out = out.where(~changed | text_of("text").rlike(r"[^\x20\x09-\x0D]"))
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.select(*(n_chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.without_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spaced_seeds.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
#: SQL can say neither the tokenizer nor the packing; the tests run the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark)
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"{folder}/{name}")  # shuffle files of a stage go when it is written
    return docs
