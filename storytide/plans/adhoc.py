"""Books or texts that are not (or not yet) part of the corpus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storytide.functions import text as tx
from storytide.operators import vectors as vec
from storytide.operators.chunking import create_chunks
from storytide.operators.joins import restrict_to
from storytide.operators.trajectory import analyze_trajectory, union_query_row
from storytide.plans.corpus import Lexicons, chunk_scores_of
from storytide.plans.recommend import recommend
from storytide.schema import BOOKS, conform
from storytide.sources.books import ID_IN_PATH, load_metadata, load_text_files, lookup_book, read_book


@dataclass
class Analysis:
    """What is known about the input books."""

    trajectory: DataFrame
    chunk_scores: DataFrame
    topics: DataFrame | None = None


def input_trajectory(
    books: DataFrame, lexicons: Lexicons, stored: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Trajectory and chunk scores of ad-hoc books, cut into an adaptive number of chunks.

    A stored trajectory of the same book is preferred; chunk scores are always fresh.
    """
    scores = chunk_scores_of(books, lexicons, tx.adaptive_chunks(F.col("text")))
    fresh = analyze_trajectory(scores)
    if stored is None:
        return fresh, scores
    wanted = restrict_to(conform(stored), books)
    missing = fresh.join(wanted.select("book_id"), "book_id", "left_anti")
    return wanted.unionByName(missing), scores


def input_topics(
    books: DataFrame, lexicons: Lexicons, num_topics: int = 10, max_iter: int = 50
) -> DataFrame:
    """Topic mixture of the input, from a model fitted on the input's own chunks."""
    chunks = create_chunks(books, tx.adaptive_chunks(F.col("text")), lexicons.stop_words).persist()
    try:
        vocabulary = vec.fit_vocabulary(chunks)
        model = vec.train_lda(vec.topic_features(chunks, vocabulary), num_topics, max_iter)
    finally:
        chunks.unpersist()
    return vec.book_topics(vec.chunk_topics(vec.topic_features(chunks, vocabulary), model))


def analyze_input(
    spark: SparkSession,
    lexicons: Lexicons,
    *,
    text_path: str | None = None,
    book_id: str | None = None,
    books_path: str = "data/books",
    metadata_path: str | None = None,
    language: str | None = None,
    stored: DataFrame | None = None,
    num_topics: int | None = None,
    id_pattern: str = ID_IN_PATH,
) -> Analysis:
    """Analyse text files, or one book of the catalogue.

    Give ``num_topics`` to fit topics on the input as well. Without any input, or for a
    book the catalogue does not list, a ``ValueError`` is raised. ``id_pattern`` says where a path
    has the id of the file, for books that are folders.
    """
    if text_path:
        books = load_text_files(spark, text_path, id_pattern)
        stored = None
    elif book_id and metadata_path:
        listed = lookup_book(load_metadata(spark, metadata_path, language), book_id)
        if listed.isEmpty():
            raise ValueError(f"book {book_id} is not in the catalogue")
        named = listed.select(F.trim("book_id").alias("book_id"), "title", "author").limit(1)
        books = conform(read_book(spark, books_path, str(book_id).strip(), id_pattern).join(named, "book_id"), BOOKS)
    else:
        raise ValueError("give a text path, or a book id with the path of its catalogue")
    trajectory, scores = input_trajectory(books, lexicons, stored)
    topics = input_topics(books, lexicons, num_topics) if num_topics else None
    return Analysis(trajectory, scores, topics)


def recommend_for(
    corpus: DataFrame, query: DataFrame, book_id: str, top_n: int = 10, limit: int | None = None, **options
) -> DataFrame:
    """Recommendations for a trajectory that need not be in the corpus.

    ``limit`` compares with the first so many books only. Further options are those of
    :func:`storytide.plans.recommend.recommend`.
    """
    if limit:
        corpus = corpus.orderBy("book_id").limit(limit)
    return recommend(union_query_row(corpus, query), book_id, top_n, **options)
