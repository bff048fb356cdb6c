"""From raw documents to coded training data, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's documents. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import jaccard, lines, mixing, pieces, quality
from tidewater.llm.common import written
from tidewater.llm.queries import PIECES, vocabulary
from tidewater.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the n-gram ratio reject go."""
    return quality.kept_documents(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines are deleted; a document that loses all its lines goes."""
    return lines.cut_documents(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row coded: number of ids, digests of the ids and of their decoding."""
    return pieces.code_digests(docs, vocabulary(PIECES))


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup),
          ("n-gram Jaccard join", jaccard_join), ("mixing sources", mix_sources),
          ("SentencePiece", sentencepiece)]

#: SQL cannot hash n-grams, draw or code alike: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
