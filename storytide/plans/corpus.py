"""The corpus pipeline: texts to trajectories."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storytide.functions import text as tx
from storytide.functions.stopwords import ENGLISH
from storytide.operators.chunking import chunk_text, create_chunks
from storytide.operators.joins import join_metadata, restrict_to, training_sample
from storytide.operators.scoring import score_chunks, score_text, word_scores
from storytide.operators.trajectory import analyze_trajectory, attach_vectors
from storytide.operators import vectors as vec
from storytide.functions.text import is_word
from storytide.schema import BOOKS, conform
from storytide.workspace import MAX_BROADCAST_ROWS, kept, within


class Lexicons:
    """The word lists that texts are scored with.

    Both lists together become one table of words, made and counted once and kept in
    memory for all scoring that follows. Kept rows also stop the optimizer from copying
    the conditions on lexicon words to every token of the corpus, which costs more than
    the lookup that they would save.
    """

    def __init__(self, emotions: DataFrame, vad: DataFrame, stop_words: Sequence[str] = ENGLISH):
        self.emotions = emotions
        self.vad = vad
        self.stop_words = stop_words

    @cached_property
    def of_words(self) -> DataFrame:
        """For chunks of words: every lexicon entry."""
        return self._kept(word_scores(self.emotions, self.vad))

    @cached_property
    def of_text(self) -> DataFrame:
        """For plain text: without the words that tokenizing would drop."""
        return self._kept(word_scores(self.emotions, self.vad, only=is_word("word", self.stop_words)))

    @cached_property
    def small(self) -> bool:
        """Whether the tables may be broadcast; they have no more rows than the lists."""
        rows = self.emotions.select(F.lit(1)).union(self.vad.select(F.lit(1)))
        return within(rows, MAX_BROADCAST_ROWS)

    def _kept(self, table: DataFrame) -> DataFrame:
        # Kept tables keep their partitions: a small one needs no more than one. It is put together
        # by a shuffle: a single task over all partitions holds the buffers of each until it ends.
        return (table.repartition(1) if self.small else table).persist()

    def release(self) -> None:
        """Drop the kept tables from memory."""
        for name in ("of_words", "of_text", "small"):
            table = self.__dict__.pop(name, None)
            if isinstance(table, DataFrame):
                table.unpersist()


def trajectories_of(
    books: DataFrame, lexicons: Lexicons, num_chunks: int | Column = tx.DEFAULT_CHUNKS, with_arc: bool = True
) -> DataFrame:
    """Books to trajectory rows, in one lazy plan."""
    return analyze_trajectory(chunk_scores_of(books, lexicons, num_chunks), with_arc)


def chunk_scores_of(
    books: DataFrame, lexicons: Lexicons, num_chunks: int | Column = tx.DEFAULT_CHUNKS
) -> DataFrame:
    pieces = chunk_text(books, num_chunks)
    return score_text(pieces, lexicons.of_text, lexicons.small)


def fit_models(
    books: DataFrame,
    sample_size: int,
    *,
    num_chunks: int = tx.DEFAULT_CHUNKS,
    vector_size: int = 100,
    num_topics: int = 10,
    lda_iterations: int = 50,
    skip_embeddings: bool = False,
    skip_topics: bool = False,
    partitions: int = 1,
    seed: int = vec.SEED,
    stop_words: Sequence[str] = ENGLISH,
) -> dict:
    """Fit the models once, on a shuffled sample of the books.

    ``stop_words`` must be those of the lexicons that the models are used with.
    """
    chosen = restrict_to(books, training_sample(books, sample_size, seed))
    chunks = create_chunks(chosen, num_chunks, stop_words).persist(StorageLevel.MEMORY_AND_DISK)
    models: dict = {}
    try:
        if not skip_embeddings:
            models["word2vec"] = vec.train_word2vec(
                chunks, vector_size, seed=seed, partitions=partitions
            )
        if not skip_topics:
            models["count_vectorizer"] = vec.fit_vocabulary(chunks)
            features = vec.topic_features(chunks, models["count_vectorizer"])
            models["lda"] = vec.train_lda(features, num_topics, lda_iterations, seed)
    finally:
        chunks.unpersist()
    return models


def enriched_trajectories(
    books: DataFrame,
    lexicons: Lexicons,
    models: dict | None = None,
    num_chunks: int = tx.DEFAULT_CHUNKS,
) -> DataFrame:
    """Trajectories with the vectors of whichever models are given.

    With models, the chunks of words are written once; scores, embeddings and topics are read from
    there, so that texts are cut and tokenized once.
    """
    books = conform(books, BOOKS)
    models = models or {}
    if not models:
        return trajectories_of(books, lexicons, num_chunks)
    chunks = kept(create_chunks(books, num_chunks, lexicons.stop_words), "chunks")
    scored = analyze_trajectory(score_chunks(chunks, lexicons.of_words, lexicons.small), keep_version=True)
    return attach_vectors(scored, *_book_vectors(chunks, models))


def catalogue_trajectories(
    books: DataFrame,
    metadata: DataFrame,
    lexicons: Lexicons,
    models: dict | None = None,
    num_chunks: int = tx.DEFAULT_CHUNKS,
) -> DataFrame:
    """Trajectories of the books of a catalogue, with its titles and authors.

    Books are scored by id alone; names are attached to the one row per book.
    """
    score = lambda listed: enriched_trajectories(listed, lexicons, models, num_chunks)
    return conform(join_metadata(books, metadata, score))


def _book_vectors(chunks: DataFrame, models: dict) -> tuple[DataFrame | None, DataFrame | None]:
    """Book embeddings and topic mixtures of the models that are given."""
    embeddings = topics = None
    if models.get("word2vec") is not None:
        embeddings = vec.book_embedding(vec.chunk_embeddings(chunks, models["word2vec"]))
    if models.get("lda") is not None:
        features = vec.topic_features(chunks, models["count_vectorizer"])
        topics = vec.book_topics(vec.chunk_topics(features, models["lda"]))
    return embeddings, topics
