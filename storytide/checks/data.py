"""The given tables in the shapes the library works on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storytide.checks import fixtures as fx
from storytide.operators.trajectory import attach_vectors
from storytide.plans.corpus import Lexicons, trajectories_of
from storytide.sources.books import spread_small_scan
from storytide.sources.tables import load_trajectories, save_trajectories
from storytide.workspace import fresh_path

_stored: dict[tuple[str, str], str] = {}
_lexicons: dict[str, Lexicons] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a catalogue with text."""
    return table(spark, sf, "documents").selectExpr(
        "string(doc_id) AS book_id",
        "concat('Document ', doc_id) AS title",
        "source AS author",
        "lang AS language",
        f"{_in_turn(fx.BOOKSHELVES)} AS bookshelves",
        f"{_in_turn(fx.SUBJECTS)} AS subjects",
        "text",
    )


def _in_turn(values: tuple) -> str:
    listed = ", ".join("string(null)" if v is None else f'"{v}"' for v in values)
    return f"array({listed})[int(doc_id % {len(values)})]"


def books(spark: SparkSession, sf: str, spread: bool = True) -> DataFrame:
    scan = catalogue(spark, sf).select("book_id", "title", "author", "text")
    return spread_small_scan(scan) if spread else scan


def metadata(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue(spark, sf).drop("text")


def lexicons(spark: SparkSession) -> Lexicons:
    app = spark.sparkContext.applicationId
    if app not in _lexicons:
        emotions = spark.sql(f"SELECT * FROM VALUES {fx.emotion_values()} AS t(word, emotion, value)")
        vad = spark.sql(f"SELECT * FROM VALUES {fx.vad_values()} AS t(term, valence, arousal, dominance)")
        _lexicons[app] = Lexicons(emotions, vad)
    return _lexicons[app]


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings of the books that have one, and mixtures that sum to one from them."""
    given = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("book_id"),
        F.col("embedding").cast("array<double>").alias("book_embedding"),
    )
    # The sum is bound once as the lambda's argument, not recomputed per element.
    sizes = "transform(book_embedding, x -> abs(x))"
    total = f"aggregate({sizes}, 0D, (a, x) -> a + x)"
    shares = f"transform(array({total}), t -> transform({sizes}, x -> x / t))[0] AS book_topics"
    return given.selectExpr("*", shares)


def computed_trajectories(spark: SparkSession, sf: str) -> DataFrame:
    given = vectors(spark, sf)
    return attach_vectors(trajectories_of(books(spark, sf), lexicons(spark)), given, given)


def trajectories(spark: SparkSession, sf: str) -> DataFrame:
    """Trajectories of the corpus, written once per session and then read.

    The same division of work as in real use: texts are scored once, and every
    recommendation, search or statistic reads the stored table.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stored:
        path = fresh_path(spark, "trajectories")
        save_trajectories(computed_trajectories(spark, sf), path)
        _stored[key] = path
    return load_trajectories(spark, _stored[key])


def rounded(rows: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles cut to a precision that does not depend on the order of summation.

    The offset moves values that lie exactly on a rounding boundary off it.
    """

    def column(field) -> str:
        name, kind = field.name, field.dataType.simpleString()
        if kind == "double":
            return f"round({name} + 1e-10D, {digits}) AS {name}"
        if kind == "array<double>":
            return f"transform({name}, x -> round(x + 1e-10D, {digits})) AS {name}"
        return name

    return rows.selectExpr(*[column(f) for f in rows.schema])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
