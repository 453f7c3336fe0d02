"""Chunk scores to one trajectory row per book."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storytide.schema import (
    AVG_DIMENSIONS,
    AVG_EMOTIONS,
    BOOK_KEY,
    CHUNK_KEY,
    EMOTIONS,
    EVEN_SHARE,
    RATIOS,
    TRAJECTORY,
    VERSION,
    conform,
    with_version,
)

TRAJECTORY_OF_VERSION = T.StructType([*TRAJECTORY, T.StructField(VERSION, T.LongType())])
NORMS = tuple(f"{e}_norm" for e in EMOTIONS)


def shares(columns: Sequence[str], names: Sequence[str]) -> list[str]:
    """SQL for each column over the sum of all; an even share where the sum is zero."""
    total = " + ".join(columns)
    return [
        f"CASE WHEN {total} > 0 THEN {c} / ({total}) ELSE {EVEN_SHARE}D END AS {n}"
        for c, n in zip(columns, names)
    ]


def normalise_chunks(chunk_scores: DataFrame) -> DataFrame:
    """Add ``<emotion>_norm``: the chunk's emotions as shares that sum to one."""
    return chunk_scores.selectExpr("*", *shares(EMOTIONS, NORMS))


def trajectory_points(chunk_scores: DataFrame) -> DataFrame:
    """The arcs in long form: one row per book and chunk position, nothing collected."""
    return normalise_chunks(chunk_scores).select(*with_version(CHUNK_KEY, chunk_scores), *NORMS)


def explode_arcs(trajectories: DataFrame) -> DataFrame:
    """Long form of stored arcs."""
    points = trajectories.where(F.col("emotion_trajectory").isNotNull()).select(
        "book_id", F.explode("emotion_trajectory").alias("p")
    )
    return points.selectExpr(
        "book_id", "int(p[0]) AS chunk_index", *[f"p[{i}] AS {n}" for i, n in enumerate(NORMS, 1)]
    )


def analyze_trajectory(chunk_scores: DataFrame, with_arc: bool = True, keep_version: bool = False) -> DataFrame:
    """One row per book: mean scores, chunk count, emotion ratios and the arc.

    Versions of a book, which differ in their text, are rows of their own; :func:`dedupe_books`
    chooses one. ``keep_version`` adds the hash of the text, for joins with vectors of the version.
    The arc holds one point per chunk position, so its length is the number of chunks a
    book is cut into. For input with unlimited positions (dialogues) leave it out and
    use :func:`trajectory_points`.
    """
    measures = [F.expr(f"avg({e}) AS {a}") for e, a in zip(EMOTIONS, AVG_EMOTIONS)]
    measures += [F.expr(f"avg({c}) AS {c}") for c in AVG_DIMENSIONS]
    measures.append(F.expr("count(chunk_index) AS num_chunks"))
    rows = chunk_scores
    if with_arc:
        rows = normalise_chunks(chunk_scores)
        point = f"array(double(chunk_index), {', '.join(NORMS)})"
        measures.append(F.expr(f"sort_array(collect_list({point})) AS emotion_trajectory"))
    books = rows.groupBy(*with_version(BOOK_KEY, rows)).agg(*measures).where(F.col("num_chunks") > 0)
    whole = books.selectExpr("*", *shares(AVG_EMOTIONS, RATIOS))
    if not keep_version or VERSION not in rows.columns:
        return conform(whole)
    return conform(whole, TRAJECTORY_OF_VERSION)


def attach_vectors(
    trajectories: DataFrame, embeddings: DataFrame | None = None, topics: DataFrame | None = None
) -> DataFrame:
    """Left-join book embeddings and topic mixtures (``book_id`` with one array each).

    Where both sides tell versions of a book apart, each version gets its own.
    """
    joined = trajectories
    for column, vectors in (("book_embedding", embeddings), ("book_topics", topics)):
        if vectors is not None:
            key = [c for c in ("book_id", VERSION) if c in joined.columns and c in vectors.columns]
            joined = joined.drop(column).join(vectors.select(*key, column), key, "left")
    return conform(joined)


def completeness_order() -> Column:
    """Total order among rows of one book: the most complete row comes first."""
    fields = ["book_embedding IS NULL", "book_topics IS NULL", "coalesce(-num_chunks, 0)"]
    return F.expr(f"struct({', '.join([*fields, 'title', 'author', *RATIOS, *AVG_DIMENSIONS])})")


def dedupe_books(trajectories: DataFrame) -> DataFrame:
    """One row per ``book_id``.

    The rank filter is applied within each task before the shuffle as well, so a book
    with very many copies reaches its task as one row per upstream task.
    """
    books = conform(trajectories)
    window = Window.partitionBy("book_id").orderBy(completeness_order())
    return books.withColumn("place", F.row_number().over(window)).where("place = 1").drop("place")


def union_query_row(corpus: DataFrame, query: DataFrame) -> DataFrame:
    """Corpus plus query trajectories, missing columns null."""
    return conform(corpus).unionByName(conform(query))
