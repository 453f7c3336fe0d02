"""Word2Vec embeddings, LDA topics and their book-level means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel, Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storytide.operators import packed, ranks, skipgram
from storytide.operators import topics as tp
from storytide.operators.means import mean_by_key
from storytide.schema import with_version
from storytide.workspace import broadcast_if_small, fresh_path, kept

SEED = 42
MAX_VOCABULARY = 1 << 18
_CHUNK = ("book_id", "chunk_index")


def vector_mean(vectors: DataFrame, key: str | Sequence[str], column: str, result: str) -> DataFrame:
    """Element-wise mean of an array column per key (one column or several); null vectors are skipped.

    The mean is a real partial aggregate: a task adds up the vectors that it holds, and sends one sum for each key
    and not its vectors (:mod:`means`).
    """
    keys = [key] if isinstance(key, str) else list(key)
    return mean_by_key(vectors.where(F.col(column).isNotNull()), keys, column, result)


def word_vectors(
    chunks: DataFrame,
    vector_size: int = 100,
    min_count: int = 5,
    seed: int = SEED,
    partitions: int = 1,
    max_iter: int = 1,
) -> DataFrame:
    """``word, vector``: skip-gram vectors of the words that occur at least ``min_count`` times, as a stored table.

    As in Spark's Word2Vec, each of ``partitions`` tasks trains on its part of the chunks, and the vectors of a
    word are averaged over the tasks that have it, after each of ``max_iter`` passes. Tasks here share no arrays, are told
    only the words that their chunks have, and pass vectors on through shuffles: nothing reaches the driver. Chunks
    are packed once (:mod:`packed`); what a pass moves and sorts are their compressed words.
    """
    rows = packed.pack(chunks, partitions, mixed=seed)
    every = kept(packed.words_of_parts(rows), "words_of_parts")
    frequent = every.groupBy("word").agg(F.sum("n").alias("total")).where(F.col("total") >= min_count).select("word")
    words = kept(every.join(frequent, "word").withColumn("key", F.xxhash64("word", F.lit(seed))), "known_words")
    if words.isEmpty():
        raise ValueError(f"no word occurs {min_count} times")
    form, vectors = "word string, vectors array<float>", None
    for turn in range(max_iter):
        told = words.withColumn("vectors", F.lit(None).cast("array<float>")) if vectors is None else words.join(vectors, "word")
        # Words first, then texts in an order by chance, so that a part has the same order in every run.
        both = packed.beside_words(rows, told.select("part", "word", "key", "n", "vectors"), partitions)
        last = turn == max_iter - 1
        train = skipgram.trainer(vector_size, seed + turn, turn / max_iter, 1 / max_iter, not last)
        learnt = both.mapInArrow(train, form)
        if partitions > 1:  # a word has at most one vector of each part
            ordered = learnt.withColumn("part", F.spark_partition_id()).repartition("word").sortWithinPartitions("word", "part")
            learnt = ordered.select("word", "vectors").mapInArrow(skipgram.averager(), form)
        vectors = kept(learnt, "word_vectors")
    return vectors.withColumnRenamed("vectors", "vector")


def train_word2vec(
    chunks: DataFrame,
    vector_size: int = 100,
    min_count: int = 5,
    seed: int = SEED,
    partitions: int = 1,
    max_iter: int = 1,
):
    """Skip-gram model of the chunk words (:func:`word_vectors`) as Spark's own, which keeps its words and vectors on the driver.

    Raise ``partitions`` to fit in parallel.
    """
    return word2vec_model(word_vectors(chunks, vector_size, min_count, seed, partitions, max_iter), vector_size, min_count, seed, max_iter)


def word2vec_model(vectors: DataFrame, vector_size: int = 100, min_count: int = 5, seed: int = SEED, max_iter: int = 1):
    """A table of ``word, vector`` as a model: Spark's saved form of one, with this table in place of its own."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([(["word"] * max(1, min_count),)], "words array<string>")
    form = Word2Vec(inputCol="words", outputCol="word_vectors", vectorSize=vector_size, minCount=min_count, seed=seed, maxIter=max_iter)
    path = fresh_path(spark, "word2vec")
    form.fit(empty).write().save(path)
    vectors.select("word", "vector").write.mode("overwrite").parquet(f"{path}/data")
    return Word2VecModel.load(path)


def chunk_embeddings(chunks: DataFrame, model) -> DataFrame:
    """Mean word vector per chunk; words unknown to the model count as zero vectors.

    ``model`` is Spark's, which the driver holds and broadcasts, or a stored table ``word, vector`` of :func:`word_vectors`,
    which no process holds as a whole.
    """
    if isinstance(model, DataFrame):
        return packed.mean_vectors(chunks, model, with_version(_CHUNK, chunks), "embedding_vector")
    embedded = model.transform(chunks.select(*with_version(_CHUNK, chunks), "words"))
    return embedded.select(
        *with_version(_CHUNK, chunks), vector_to_array("word_vectors").alias("embedding_vector")
    )


def book_embedding(embeddings: DataFrame) -> DataFrame:
    return vector_mean(embeddings, with_version(("book_id",), embeddings), "embedding_vector", "book_embedding")


def vocabulary_table(chunks: DataFrame, min_df: float = 2.0) -> DataFrame:
    """``word, n, chunks, place``: the words of at least ``min_df`` chunks (below 1: that share of all chunks).

    ``n`` counts occurrences, ``place`` numbers words from the most frequent one, equal ones by
    spelling. Occurrences and chunks of a word are counted in one pass, in each task first; the
    vocabulary of a corpus of any size stays a table.
    """
    least = F.lit(min_df)
    if min_df < 1:
        least = F.lit(min_df) * chunks.agg(F.count("*").alias("n")).scalar()
    once, seen = F.lit(1).cast("long"), F.lit(0).cast("long")
    every = F.transform("words", lambda w: F.struct(w.alias("word"), once.alias("n"), seen.alias("chunks")))
    each = F.transform(F.array_distinct("words"), lambda w: F.struct(w.alias("word"), seen.alias("n"), once.alias("chunks")))
    rows = chunks.select(F.explode(F.concat(every, each)).alias("t")).select("t.*")
    counted = rows.groupBy("word").agg(F.sum("n").alias("n"), F.sum("chunks").alias("chunks")).where(F.col("chunks") >= least)
    return ranks.numbered(counted, [F.desc("n"), F.asc("word")], "place")


def fit_vocabulary(chunks: DataFrame, vocab_size: int = 5000, min_df: float = 2.0):
    """The ``vocab_size`` most frequent words as a model that counts them; one chunk is one document.

    Only these words reach the driver, at most ``MAX_VOCABULARY``.
    """
    if vocab_size > MAX_VOCABULARY:
        raise ValueError(f"a model has at most {MAX_VOCABULARY} words; count more with term_counts")
    words = vocabulary_table(chunks, min_df).where(F.col("place") < vocab_size).orderBy("place").select("word").collect()
    if not words:
        raise ValueError(f"no word occurs in {min_df:g} chunks")
    return CountVectorizerModel.from_vocabulary([row.word for row in words], inputCol="words", outputCol="features")


def topic_features(chunks: DataFrame, vocabulary) -> DataFrame:
    """Term counts per chunk."""
    return vocabulary.transform(chunks.select(*with_version(_CHUNK, chunks), "words"))


def term_counts(chunks: DataFrame, min_df: float = 2.0) -> DataFrame:
    """``word, n``: how often each word of the vocabulary occurs in all chunks together."""
    return vocabulary_table(chunks, min_df).select("word", "n")


def count_vectors(chunks: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``place, n`` for each word that a chunk has: the count vectors of a vocabulary of any size, as a table.

    ``vocabulary`` is a :func:`vocabulary_table`; it is broadcast only if it is small.
    """
    key = with_version(_CHUNK, chunks)
    places = broadcast_if_small(vocabulary.select("word", "place"))
    words = chunks.select(*key, F.explode("words").alias("word")).join(places, "word")
    return words.groupBy(*key, "place").agg(F.count(F.lit(1)).alias("n"))


def train_lda(features: DataFrame, num_topics: int = 10, max_iter: int = 50, seed: int = SEED, batches: DataFrame | None = None):
    """Topics of the count vectors, by online variational Bayes with mini-batches of 5 % (:mod:`topics`).

    The vectors are counted and dealt into mini-batches once, as a stored table; ``batches`` is that table
    (:func:`topics.mini_batches`) where several fits share it.
    """
    if batches is None:
        batches = tp.mini_batches(features, seed)
    weights, alpha = tp.fit(batches, num_topics, max_iter, seed)
    return tp.as_model(batches, weights, alpha, max_iter, seed)


def chunk_topics(features: DataFrame, model) -> DataFrame:
    """Topic mixture per chunk."""
    return tp.mixtures(features, with_version(_CHUNK, features), *tp.of_model(model), "topic_distribution")


def book_topics(topics: DataFrame) -> DataFrame:
    return vector_mean(topics, with_version(("book_id",), topics), "topic_distribution", "book_topics")


def topic_rank(books: DataFrame, top: int = 5) -> DataFrame:
    """The strongest topics of each book, numbered from 1; sorted within the row."""
    numbered = F.transform(
        "book_topics", lambda weight, i: F.struct((-weight).alias("minus"), (i + 1).alias("topic"))
    )
    best = F.slice(F.array_sort(numbered), 1, top)
    ranked = books.where(F.col("book_topics").isNotNull()).select(
        "book_id", F.posexplode(best).alias("place", "entry")
    )
    return ranked.select(
        "book_id",
        (F.col("place") + 1).alias("rank"),
        F.col("entry.topic").alias("topic"),
        (-F.col("entry.minus")).alias("weight"),
    )
