"""The corpus pipeline: toxic texts, boilerplate lines and near copies go, sources are mixed, texts encoded.

Stages take (spark, docs, sf_dir) and return a DataFrame; each is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import toxicity
from martloom.llm.common import Scratch, table
from martloom.llm.line_dedup import drop_spread_lines
from martloom.llm.mixing import mix
from martloom.llm.pieces import encode_texts
from martloom.llm.queries import vocabulary_path
from martloom.llm.simhash import simhash_dedup


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels, does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, score_col="__score")
    return scored.where(F.col("__score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that spread over many sources but for their first place."""
    out = drop_spread_lines(docs, removed_col="__removed")
    size = docs.schema["n_chars"].dataType
    changed = F.when(F.col("__removed") > 0, F.length("text").cast(size)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of fingerprints linked by two differing bits or fewer."""
    return simhash_dedup(docs, width=3, tau=2).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that source, language and topic come nearer to their target shares."""
    columns = docs.columns
    return mix(docs, bounded=True).where("kept").select(*columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their piece ids; the text itself is left behind."""
    return encode_texts(docs, vocabulary_path()).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("SentencePiece", encode),
]

# A classifier, components of a graph and Viterbi paths are beyond SQL; the tests compare each stage
# with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.write(docs)
    return docs
