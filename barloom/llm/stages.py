"""The stages of the corpus pipeline: each takes and returns documents, and its decisions take effect."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import exact_dedup, language_id, mixing, near_dedup, packing
from barloom.llm.common import text_or_empty


CONTRADICTED = 0.3  # score from which another language than the label's counts; 99 of 100 right predictions score above
LEAST_LETTERS = 50  # shorter texts contradict no label


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their language: a missing label is filled by the prediction.

    Those without any letter (``und``) go, labels or not, and those whose label the text clearly contradicts.
    """
    model = language_id.training_text(docs, F.lit(True))
    judged = language_id.predict(docs, model, docs.columns).where(F.col("lang_pred") != language_id.UNKNOWN)
    letters = F.length(F.regexp_replace(text_or_empty("_row.text"), r"[^\p{L}\p{M}]+", ""))
    contradicted = (F.col("lang_pred") != F.col("_row.lang")) & (F.col("score") >= CONTRADICTED) & (letters >= LEAST_LETTERS)
    kept = judged.where(~F.coalesce(contradicted, F.lit(False)))
    return kept.select(*[F.coalesce("_row.lang", "lang_pred").alias(c) if c == "lang" else F.col(f"_row.`{c}`") for c in docs.columns])


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, release=True)
