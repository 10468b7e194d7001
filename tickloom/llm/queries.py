"""Registered queries of this subpackage and, where SQL can say them, their SQL forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    importance,
    license_scan,
    line_windows,
    ngram_join,
    packing,
    repetition,
    secret_scan,
    spaced_seeds,
    spelling,
    subword_lattice,
    suffix_buckets,
    top_products,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_buckets.without_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(_table(spark, sf_dir, "documents"))
    return found.withColumn("base_spans", F.sha2("base_spans", 256)).withColumnRenamed("base_spans", "base_sha256")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality(_table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_windows.without_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.md5("text").alias("kept_md5"))


OP8_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
c AS (SELECT doc_id, i, line, row_number() OVER d AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
w AS (SELECT doc_id, n, line || chr(10) || lead(line, 1) OVER d || chr(10) || lead(line, 2) OVER d AS w FROM c WINDOW d AS (PARTITION BY doc_id ORDER BY n)),
later AS (SELECT doc_id, n FROM (SELECT doc_id, n, row_number() OVER (PARTITION BY w ORDER BY doc_id, n) AS place FROM w WHERE w IS NOT NULL) WHERE place > 1),
gone AS (SELECT DISTINCT c.doc_id, c.i FROM later JOIN c ON c.doc_id = later.doc_id AND c.n BETWEEN later.n AND later.n + 2)
SELECT l.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed,
  md5(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL), '')) AS kept_md5
FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.i = l.i GROUP BY l.doc_id
"""


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spaced_seeds.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumn("item_ids", F.array_join("item_ids", ","))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_lattice.scored(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


OP9_SQL = """
WITH d AS (SELECT doc_id, [w FOR w IN regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+') IF w <> ''] AS ws FROM documents),
b AS (SELECT item_id, [w FOR w IN regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+') IF w <> ''] AS ws FROM benchmark),
dw AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
bw AS (SELECT item_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM b),
eq AS (SELECT DISTINCT doc_id, item_id, n, dw.p - bw.p AS shift, bw.p AS p FROM dw JOIN bw USING (w)),
-- a best window starts with an equal word or at the last place where it fits
starts AS (SELECT DISTINCT doc_id, item_id, n, shift, least(p, greatest(n - 15, 1)) AS s FROM eq),
wins AS (
  SELECT s.doc_id, s.item_id, s.n, s.shift, s.s, count(*) AS n_equal
  FROM starts s JOIN eq e ON e.doc_id = s.doc_id AND e.item_id = s.item_id AND e.shift = s.shift AND e.p >= s.s AND e.p < s.s + 16
  GROUP BY ALL),
pairs AS (SELECT doc_id, item_id, max(n_equal) AS n_equal FROM wins WHERE n_equal >= CASE WHEN n >= 16 THEN 13 ELSE ceil(n * 13 / 16) END GROUP BY ALL),
per_doc AS (SELECT doc_id, count(*) AS n_items, max(n_equal) AS best_equal, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_ids FROM pairs GROUP BY doc_id)
SELECT documents.doc_id, n_items IS NOT NULL AS contaminated, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  CAST(coalesce(best_equal, 0) AS BIGINT) AS best_equal, coalesce(item_ids, '') AS item_ids
FROM documents LEFT JOIN per_doc ON documents.doc_id = per_doc.doc_id
"""


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products.top_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


# The checksum that SQL lacks, bit by bit: every byte as itself and seven zeros, a step of the division for each.
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, strlen({text}) + 1),
      lambda i: [('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295)"""

OP11_SQL = """
WITH texts AS (
  SELECT 0 AS side, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
  UNION ALL SELECT 1, NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
words AS (SELECT side, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
buckets AS (SELECT word, CRC % 10000 AS bucket FROM (SELECT DISTINCT word FROM words)),
counts AS (SELECT bucket, count(*) FILTER (WHERE side = 0) AS s, count(*) FILTER (WHERE side = 1) AS t FROM words JOIN buckets USING (word) GROUP BY bucket),
sums AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gains AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM counts, sums),
per_doc AS (SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total FROM words JOIN buckets USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id),
weighed AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
    CAST('0x' || substr(sha256('2024:' || CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h
  FROM documents d LEFT JOIN per_doc p ON p.doc_id = d.doc_id),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM weighed),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored s LEFT JOIN placed p ON p.doc_id = s.doc_id
""".replace("CRC", _CRC32.format(text="word"))

OP12_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM s
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 5
"""

OP13_SQL = """
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT run, CAST(doc_id AS VARCHAR) || ':' || run AS named, count(*) AS n FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, n, CRC AS h FROM counted WHERE length(run) >= 6),
spelled AS (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
edits AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
near AS (SELECT word, count(*) AS n_near, arg_min(other, row(-other_n, other)) AS best, max(other_n) AS best_n FROM edits GROUP BY word),
forms AS (SELECT w.word, CASE WHEN best_n >= 5 * n THEN best END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n FROM words w LEFT JOIN near ON near.word = w.word),
chain AS (SELECT word, word AS node, 0 AS steps FROM forms UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN forms f ON f.word = c.node WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(node, steps) AS root FROM chain GROUP BY word) USING (word)
""".replace("CRC", _CRC32.format(text="named"))

OP3_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS ws FROM documents),
s AS (SELECT doc_id, hash(unnest(CASE WHEN len(ws) >= 5 THEN list_distinct([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)])
  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * n_both >= 75 * (na.n + nb.n - n_both)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

# Bytes as pairs of hexadecimal digits.
OP4_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM (SELECT doc_id, h, unnest(range(0, strlen(h) // 2 - 199)) AS i FROM d)),
starts AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY m) AS n FROM strings) WHERE n > 1),
marked AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER w + 200 THEN 1 ELSE 0 END AS opens FROM starts WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY doc_id, span),
pieces AS (
  SELECT doc_id, a AS place, coalesce(lag(b) OVER w, 0) AS from_byte, a AS to_byte FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT d.doc_id, strlen(h) // 2, coalesce(max(b), 0), strlen(h) // 2 FROM d LEFT JOIN spans ON spans.doc_id = d.doc_id GROUP BY d.doc_id, h),
kept AS (SELECT d.doc_id, sha256(unhex(string_agg(substr(h, 2 * from_byte + 1, 2 * (to_byte - from_byte)), '' ORDER BY place))) AS kept_sha256 FROM d JOIN pieces USING (doc_id) GROUP BY d.doc_id),
removed AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, strlen(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_quality_rules": op6_quality_rules,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_line_dedup": op8_line_dedup,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_top_products": op12_top_products,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE_SQL: dict[str, str] = {
    "op3_ngram_jaccard_join": OP3_SQL,
    "op4_suffix_array_dedup": OP4_SQL,
    "op8_line_dedup": OP8_SQL,
    "op9_benchmark_decontamination": OP9_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op12_top_products": OP12_SQL,
    "op13_spelling_variants": OP13_SQL,
}
