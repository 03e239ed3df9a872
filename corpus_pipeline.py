"""From documents to token files in stages; each works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.llm import classifier, decontaminate, mixing, simhash, token_files
from fieldmart.llm.common import table, whole_row, work_path
from fieldmart.session import tune

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# No SQL: trained scores, XXH64 fingerprints, random draws and tokenizer ids have no equivalent there.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels of the documents it gets."""
    model = classifier.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(classifier.scorer(docs, model)("text") >= 0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.survivors(docs, shingle=3, bits=3)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go."""
    rows = docs.select(whole_row(docs), "text")
    found = decontaminate.marked(rows, table(spark, sf_dir, "benchmark"), size=13)
    clean = ~decontaminate.is_contaminated(decontaminate.hit_words(), F.col("decontaminated.n_words"))
    return found.filter(clean).select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole, in the order of the output shards."""
    return mixing.mixed(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all texts, read back: where each document's ids stand, how many, and their checksum."""
    return token_files.token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end=2)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", clean_of_benchmark),
    ("mixing to target weights", mixed),
    ("token-ID output", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read by the next."""
    docs = table(tune(spark), sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = work_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
