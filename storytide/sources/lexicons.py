"""Tab-separated lexicons. Lines with missing or unreadable fields are skipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _field(i: int) -> Column:
    return F.get(F.split("value", "\t"), F.lit(i))


def load_emotion_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``word, emotion, value`` of all lines whose value is 1."""
    fields = spark.read.text(path).select(
        _field(0).alias("word"),
        _field(1).alias("emotion"),
        _field(2).try_cast("int").alias("value"),
    )
    return fields.where((F.col("value") == 1) & F.col("word").isNotNull() & F.col("emotion").isNotNull())


def load_vad_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``term, valence, arousal, dominance``; the header line is skipped."""
    fields = spark.read.text(path).select(
        _field(0).alias("term"), *[_field(i).alias(n) for i, n in enumerate(("valence", "arousal", "dominance"), 1)]
    )
    body = fields.where((F.col("term") != "term") & F.col("valence").isNotNull())
    return body.select(
        F.trim("term").alias("term"),
        *[F.col(n).try_cast("double").alias(n) for n in ("valence", "arousal", "dominance")],
    ).where(F.col("valence").isNotNull())
