"""Corpus statistics and recommendation quality."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storytide.operators import ranks
from storytide.plans.explore import superlatives
from storytide.plans.recommend import preset_comparison, recommend_batch
from storytide.schema import DIMENSIONS, EMOTIONS
from storytide.workspace import kept


def _distribution(trajectories: DataFrame, columns: dict[str, str], label: str) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of several columns in one aggregate."""

    def stats(name: str, column: str) -> str:
        return f"""struct('{name}' AS {label}, avg({column}) AS mean,
          coalesce(stddev_samp({column}), 0D) AS std, min({column}) AS min, max({column}) AS max)"""

    entries = ", ".join(stats(name, column) for name, column in columns.items())
    row = trajectories.agg(F.expr(f"array({entries})").alias("entries"))
    return row.select(F.explode("entries").alias("e")).select("e.*")


def emotion_distribution(trajectories: DataFrame) -> DataFrame:
    return _distribution(trajectories, {e: f"ratio_{e}" for e in EMOTIONS}, "emotion").orderBy(
        F.desc("mean"), "emotion"
    )


def vad_distribution(trajectories: DataFrame) -> DataFrame:
    return _distribution(trajectories, {d: f"avg_{d}" for d in DIMENSIONS}, "dimension")


def overall_tone(trajectories: DataFrame) -> DataFrame:
    """Sign of the corpus means: positive or negative, high energy or calm."""
    means = trajectories.agg(F.avg("avg_valence").alias("valence"), F.avg("avg_arousal").alias("arousal"))
    return means.select(
        F.when(F.col("valence") > 0, "positive").otherwise("negative").alias("tone"),
        F.when(F.col("arousal") > 0, "high energy").otherwise("calm").alias("energy"),
        "valence",
        "arousal",
    )


def query_quality(recommendations: DataFrame) -> DataFrame:
    """Per query: the best hit, the mean of the first five scores, and those five."""
    first = F.col("rank") == 1
    top5 = F.when(F.col("rank") <= 5, F.col("similarity"))
    listed = F.when(F.col("rank") <= 5, F.struct("rank", "book_id", "title", "similarity"))
    return recommendations.groupBy("query_id").agg(
        F.max(F.when(first, F.col("book_id"))).alias("top_rec_id"),
        F.max(F.when(first, F.col("title"))).alias("top_recommendation"),
        F.max(F.when(first, F.col("similarity"))).alias("top_similarity"),
        F.avg(top5).alias("avg_top5_similarity"),
        F.sort_array(F.collect_list(listed)).alias("top_5"),
    )


# Quantiles are elements of the ordered scores, not interpolated: at these shares of their number.
QUANTILES = {"p25": (1, 4), "median": (1, 2), "p75": (3, 4)}


def similarity_stats(recommendations: DataFrame) -> DataFrame:
    """Statistics of all recommended scores. They are stored first, so that books are compared once."""
    recommendations = kept(recommendations.select("query_id", "book_id", "similarity"), "scores")
    score = F.col("similarity")
    places = ranks.values_at(recommendations, "similarity", QUANTILES, ties=("query_id", "book_id"))
    stats = recommendations.agg(
        F.count(score).alias("n"), F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.min(score).alias("min"), F.max(score).alias("max")
    )
    found = stats.withColumn("places", places.select(F.struct(*QUANTILES)).scalar())
    return found.select("n", "mean", F.col("places.median"), "std", "min", "max", F.col("places.p25"), F.col("places.p75"))


def reciprocity(recommendations: DataFrame) -> DataFrame:
    """How often the best hit of a query, if it is a query too, points back. Best hits are stored and met with themselves."""
    best = kept(recommendations.where("rank = 1").select("query_id", F.col("book_id").alias("best")), "best")
    back = best.select(F.col("query_id").alias("best"), F.col("best").alias("returns_to"))
    pairs = best.join(back, "best")
    return pairs.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.coalesce(F.avg((F.col("returns_to") == F.col("query_id")).cast("double")), F.lit(0.0)).alias(
            "reciprocity_rate"
        ),
    )


def evaluation_report(
    trajectories: DataFrame,
    ids: Sequence[str],
    metadata: DataFrame | None = None,
    top_n: int = 10,
    preset: str = "balanced",
) -> DataFrame:
    """Quality metrics of a set of query books as one row."""
    return _quality(kept(recommend_batch(trajectories, ids, top_n, preset=preset, metadata=metadata), "hits"), ids)


def _quality(hits: DataFrame, ids: Sequence[str]) -> DataFrame:
    tested = hits.agg(F.count_distinct("query_id").cast("int").alias("n")).scalar()
    rate = reciprocity(hits).select("reciprocity_rate").scalar()
    row = similarity_stats(hits)
    return row.select(tested.alias("books_tested"), (F.lit(len(set(ids))) - tested).alias("books_skipped"), rate.alias("reciprocity_rate"), *row.columns)


def full_report(
    trajectories: DataFrame,
    ids: Sequence[str],
    metadata: DataFrame | None = None,
    *,
    names: dict[str, str] | None = None,
    genres: dict[str, Sequence[str]] | None = None,
    preset_book: str | None = None,
    top_n: int = 10,
    preset: str = "balanced",
) -> DataFrame:
    """The whole evaluation as one nested row, to be saved with :func:`storytide.sources.tables.save_report`.

    ``names`` and ``genres`` say what is expected of the query books, ``preset_book`` is the one for which the presets are
    compared (by default the first). Everything nested is as long as ``ids``, the list of presets or that
    of emotions. Times are those of the one job that compares all query books.
    """
    spark = trajectories.sparkSession
    ids = list(dict.fromkeys(str(i) for i in ids))
    started = time.monotonic()
    hits = kept(recommend_batch(trajectories, ids, top_n, preset=preset, metadata=metadata), "hits")
    seconds = time.monotonic() - started
    compared = kept(preset_comparison(trajectories, [preset_book or ids[0]], metadata), "presets")

    # Field names of the report.
    given = [(i, (names or {}).get(i), list((genres or {}).get(i, []))) for i in ids]
    about = spark.createDataFrame(given, "book_id string, book_name string, expected_genres array<string>")
    quality = query_quality(hits).withColumnRenamed("query_id", "book_id")
    listed = F.transform("top_5", lambda hit: F.struct(hit["title"].alias("title"), hit["similarity"].alias("similarity"), hit["book_id"].alias("book_id")))
    fields = ["book_id", "book_name", "expected_genres", "top_recommendation", "top_rec_id", "top_similarity", "avg_top5_similarity"]
    books = about.join(quality, "book_id").select(F.struct(*fields, listed.alias("top_5")).alias("book"))
    per_book = books.agg(F.sort_array(F.collect_list("book")).alias("books")).scalar()
    flat = _quality(hits, ids)
    stats = F.struct(F.col("n").alias("count"), "mean", "median", "std", "min", "max", "p25", "p75")
    each = F.when(F.col("books_tested") > 0, F.lit(seconds) / F.col("books_tested"))
    timed = F.struct(F.lit(seconds).alias("total_time"), each.alias("mean_time"))
    quality_row = flat.select(
        F.struct(
            per_book.alias("per_book_results"), stats.alias("similarity_stats"), timed.alias("performance_stats"), "reciprocity_rate", "books_tested", "books_skipped"
        ).alias("recommendation_quality")
    )

    def as_map(rows: DataFrame, key: str, value: Column) -> Column:
        entries = rows.select(F.struct(F.col(key).alias("key"), value.alias("value")).alias("entry"))
        return entries.agg(F.map_from_entries(F.sort_array(F.collect_list("entry"))).alias("m")).scalar()

    hit = F.struct("rank", "book_id", "title", "similarity")
    by_preset = compared.groupBy("preset").agg(F.sort_array(F.collect_list(hit)).alias("hits"))
    four = F.struct("mean", "std", "min", "max")
    return quality_row.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        trajectories.agg(F.count("*").alias("n")).scalar().alias("corpus_size"),
        "recommendation_quality",
        as_map(by_preset, "preset", F.col("hits")).alias("preset_comparison"),
        as_map(emotion_distribution(trajectories), "emotion", four).alias("emotion_distribution"),
        as_map(vad_distribution(trajectories), "dimension", four).alias("vad_distribution"),
        as_map(superlatives(trajectories), "label", F.struct("title", "author", "value")).alias("superlatives"),
    )
