"""From raw documents to token ids, in five stages that each keep what the next one reads.

Each stage works on all rows its predecessor kept. All but the last return the
columns of documents; a row without a doc_id is kept by every stage that decides
about ids, and a null text counts as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostpulse.llm.copies import copy_groups
from hostpulse.llm.decontaminate import without_leaks
from hostpulse.llm.lines import dedup_lines
from hostpulse.llm.pieces import encode_pieces
from hostpulse.llm.store import written
from hostpulse.llm.toxicity import fit_toxicity, without_toxic

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MODEL = "piece_bpe_32k.model"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model learnt from the labelled ones does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without_toxic(docs, fit_toxicity(docs, labels)).select(*COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that a smaller doc_id holds; n_chars counts what is left."""
    rest = dedup_lines(docs.select(*COLUMNS))
    return rest.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (four fifths of the shingles) the smallest doc_id."""
    others = copy_groups(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(written(others), "doc_id", "left_anti").select(*COLUMNS)


def reject_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digest of what they decode to."""
    return encode_pieces(docs, MODEL, ("n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_shared_lines),
    ("simhash_dedup", keep_one_of_each_group),
    ("decontamination", reject_benchmark),
    ("pieces", encode),
]

# SQL has no model to learn, no 64-bit shingle hash and no edit distance of words: the tests hold
# each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage returns for ``documents``; each stage's rows are written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
