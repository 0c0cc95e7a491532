"""Documents to packed training sequences, stage by stage.

Each stage but the last returns the columns it was given, whatever else than those of documents
they are named, and no rows for an empty table. Very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.llm.common import free_name, keep, read_table
from shelfstream.llm.language import documents_in, fit_language
from shelfstream.llm.packing import pack_documents
from shelfstream.llm.privacy import pseudonymize
from shelfstream.llm.quality import fit_quality, good_documents
from shelfstream.llm.simhash import one_per_group

#: A document whose best language has a smaller mean probability is in none of them.
MIN_LANGUAGE_SCORE = 0.35
#: Replaced by a secret of the user's own; pseudonyms made with it can be turned back.
PSEUDONYM_KEY = "corpus pipeline"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents the classifier scores below its threshold.

    A NULL text is scored as an empty one; a NULL id teaches nothing and is scored.
    """
    return good_documents(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in none of the languages known.

    A NULL text, or one without a letter, is in none.
    """
    return documents_in(docs, fit_language(docs), MIN_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group.

    Texts without words, NULL ones too, are one group. Of repeated rows one stays.
    """
    return one_per_group(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms.

    A NULL text stays NULL; ``n_chars`` is counted anew.
    """
    spans = free_name(docs, "spans")
    replaced = pseudonymize(docs, PSEUDONYM_KEY, spans_col=spans).select(*docs.columns)
    return replaced.withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences.

    A NULL or empty text is a piece of length 0; no NULL source conflicts with another.
    """
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("pii", pii),
    ("packing", packing),
]

# The stages learn, hash and search; no SQL gives their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
