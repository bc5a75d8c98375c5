"""Work records and feature tables derived from the driver tables.

``documents`` stands in for the raw work records: the first line is the
title, the rest the abstract, ``lang`` the language and ``source`` the type;
``labels.quality`` is the binary label (a left join, so unlabeled works carry
null labels like the test split). Splits are assigned by a seeded hash of the
id: 80 % train, 10 % val, 10 % test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, text
from ..sources.tables import table

SPLIT_SEED = 7
TRAIN_FRACTION = 0.8
VAL_FRACTION = 0.1

TEXT_FEATURES = ["title_length", "abstract_length", "has_abstract", "title_word_count",
                 "abstract_word_count", "nlp_char_count", "nlp_word_count", "nlp_avg_word_length",
                 "nlp_sentence_count", "nlp_avg_sentence_length", "nlp_capital_ratio",
                 "nlp_number_ratio", "nlp_punctuation_ratio"]


def split_of(id_col) -> F.Column:
    u = keys.seeded_unit(id_col, SPLIT_SEED)
    return (F.when(u < TRAIN_FRACTION, F.lit("train"))
            .when(u < TRAIN_FRACTION + VAL_FRACTION, F.lit("val"))
            .otherwise(F.lit("test")))


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, title, abstract, language, type, n_chars, label, toxic, split."""
    docs = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"),
                                               "toxic")
    base = docs.select(
        F.col("doc_id").alias("id"),
        text.first_line("text").alias("title"),
        text.after_first_line("text").alias("abstract"),
        F.col("lang").alias("language"),
        F.col("source").alias("type"),
        "n_chars")
    return base.join(lab, "id", "left").withColumn("split", split_of("id"))


def work_features(w: DataFrame) -> DataFrame:
    """Base feature table X: id, type, language, text features (F1-F4, F22-F25), label, split."""
    combined = text.combined_text("title", "abstract")
    return w.select(
        "id",
        F.coalesce("type", F.lit("unknown")).alias("type"),
        F.coalesce("language", F.lit("unknown")).alias("language"),
        *text.title_abstract_features("title", "abstract"),
        *text.nlp_features(combined),
        "n_chars", "label", "split")


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base feature table (plus ``toxic``), written once per session like the reference's
    ``X_{split}`` files; later queries read it (column pruning and filter pushdown apply)
    instead of re-running the text expressions."""
    from .materialize import materialized

    def build():
        w = works(spark, sf_dir)
        return work_features(w).join(w.select("id", "toxic"), "id")
    return materialized(spark, "work-features", sf_dir, build, ("split",))
