"""Labelled corpora made from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexisift.session import spread
from lexisift.sources.corpus import compose_text, labelled_documents, read_table
from lexisift.sources.words import english_stop_words

STOP_WORDS = english_stop_words


def documents(spark: SparkSession, folder: str, category: str = "lang",
              null_text: str = "empty") -> DataFrame:
    """``(doc_id, category, text)`` of the documents."""
    table = spread(read_table(spark, folder, "documents", ["doc_id", "text", category]))
    return labelled_documents(table, "text", category, keep=["doc_id"], null_text=null_text)


def titled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose text is composed of two columns."""
    table = spread(read_table(spark, folder, "documents", ["doc_id", "text", "source", "lang"]))
    return labelled_documents(compose_text(table, ["text", "source"]), "text", "lang",
                              keep=["doc_id"])


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns, labelled with their role."""
    table = spread(read_table(spark, folder, "conversations", ["conv_id", "turn", "text", "role"]))
    return labelled_documents(table, "text", "role", keep=["conv_id", "turn"])


def rated_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a quality label, labelled with it."""
    rated = read_table(spark, folder, "labels", ["doc_id", "quality"])
    table = spread(read_table(spark, folder, "documents", ["doc_id", "text"])).join(rated, "doc_id")
    return labelled_documents(table, "text", "quality", keep=["doc_id"])
