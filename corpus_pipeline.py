"""A corpus pipeline over ``documents``: quality, language, near duplicates,
packing.  Every stage calls a corpus operator on all rows that the stage before
kept; all but the last return rows of ``documents`` with its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm.common import job_dir, rows_of, table
from pulsekit.llm.queries import BYTE_TOKENIZER, tokenizer_path, trusted_ids

#: A language is rejected as not told below this mean probability.
LEAST_LANGUAGE_SCORE = 0.35


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with an acceptable perplexity; empty texts go."""
    from pulsekit.llm.kn_quality import quality

    return rows_of(docs, quality(docs, trusted_ids(spark, sf_dir)).where("keep"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language is told: texts without letters (``und``) and those of
    which no language is likely go."""
    from pulsekit.llm.byte_cnn_lang import carried_names, held_out, predict, train

    told = predict(docs, train(docs, ~held_out()), carry=True)
    lang, score = carried_names(docs)
    return (told.where((F.col(lang) != "und") & (F.col(score) >= LEAST_LANGUAGE_SCORE))
            .select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts: shingles of five words,
    similarity of at least 0.8, the smallest doc_id stays, its rows once."""
    from pulsekit.llm.jaccard_join import join

    return rows_of(docs, join(docs, words=5, num=80, den=100).where("stays"), once=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their place in the sequences."""
    from pulsekit.llm.bin_packing import pack_documents

    return pack_documents(docs, tokenizer_path(BYTE_TOKENIZER), end_id=0, capacity=2048)


STAGES = [
    ("quality classifier", quality_classifier),
    ("language id", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("best-fit packing", packing),
]

#: The model, the tokenizer and the search are outside SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read by the next."""
    folder = job_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
