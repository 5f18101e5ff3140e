"""The corpus pipeline: five operators one after another over documents.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and reread as the next stage's docs. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foehn.llm import mixing, ngram_join, packing, pii, toxicity
from foehn.llm.queries import tokenizer_path
from foehn.llm.store import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. Null and empty texts have the score of
    no words; rows with null or repeated ids are judged by their text. Without
    labels of both kinds nothing goes; no documents give none."""
    return toxicity.without_toxic(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that with the smallest
    id; of repeated rows, one. Texts that are null or without words all stay;
    no documents give none."""
    return ngram_join.keep_one(spark, docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, and n_chars follows. Every row
    stays, repeated ones and those with null ids too; null and empty texts stay
    as they are; no documents give none."""
    return pii.redact(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stands as often as the mix of sources takes it, up to three
    times. A null source is a source of its own; null and empty texts stand
    once; rows of equal id and size share their copies; no documents give
    none."""
    return mixing.repeat_documents(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places in fixed-length sequences. Every row is a
    document, copies and null ids too; a null or empty text is one end id; no
    documents give no pieces."""
    return packing.pack_documents(spark, docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("pii", hide_personal_data),
    ("mixing", mix_sources),
    ("best_fit_packing", pack),
]

#: A trained classifier and a tokenizer have no SQL form. A test holds every
#: stage and run() against a plain version, row by row, on a small fixture
#: (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
