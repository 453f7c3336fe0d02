"""What must not grow with the tables: memory, reads and passes of single steps."""

import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helpers import books, lexicons
from storytide.checks import models as checks
from storytide.checks import queries
from storytide.checks.oracle import oracle
from storytide.checks.queries import REGISTRY
from storytide.operators import vectors as vec
from storytide.operators.chunking import create_chunks
from storytide.plans import evaluate
from storytide.plans import recommend as rec
from storytide.sources import books as src

DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_merged_tasks(spark, monkeypatch):
    """Whoever merges partitions into one task fails."""

    def coalesce(self, n):
        raise AssertionError(f"all partitions merged into {n}")

    monkeypatch.setattr(type(spark.range(1)), "coalesce", coalesce)


def test_lexicons_are_not_put_together_in_one_task(spark, no_merged_tasks):
    lists = lexicons(spark)
    assert lists.of_words.rdd.getNumPartitions() == lists.of_text.rdd.getNumPartitions() == 1
    assert "Coalesce" not in lists.of_words._jdf.queryExecution().toString()
    lists.release()


def test_one_book_is_found_by_all_tasks_of_the_scan(spark, no_merged_tasks):
    assert REGISTRY["adhoc_book_by_id"](spark, DIR).count() == 1


def sample(spark, n=12):
    words = ["whale", "ship", "harpoon", "storm", "wedding", "dance", "letter"]
    texts = [(str(i), " ".join(words[(i * j + j // 3) % 7] for j in range(40))) for i in range(n)]
    return create_chunks(books(spark, [*texts, ("bare", "of it")]), 2)


def test_count_vectors_are_made_once_for_a_fit(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(row):
        made.add(1)
        return row

    rows = [(str(i), 0, Vectors.sparse(5, [i % 5, (i + 1) % 5] if i % 5 < 4 else [0, 4], [2.0, 1.0])) for i in range(40)]
    schema = spark.createDataFrame(rows[:1], ["book_id", "chunk_index", "features"]).schema
    features = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4).map(counted), schema)
    vec.train_lda(features, 2, 6)
    assert made.value == len(rows)


def test_likelihood_of_all_words(spark):
    chunks = sample(spark).cache()
    vocabulary = vec.fit_vocabulary(chunks)
    features = vec.topic_features(chunks, vocabulary)
    model = vec.train_lda(features, 3, 5)
    weights = model.topicsMatrix().toArray()
    shares = weights / weights.sum(axis=0)
    mixtures = {(r.book_id, r.chunk_index): r.topic_distribution for r in vec.chunk_topics(features, model).collect()}
    want = 0.0
    for row in chunks.collect():
        for word in row.words:
            if word in vocabulary.vocabulary:
                mixture = mixtures[row.book_id, row.chunk_index]
                want += math.log(sum(m * s for m, s in zip(mixture, shares[vocabulary.vocabulary.index(word)])))
    assert checks.log_likelihood(chunks, vocabulary, model) == pytest.approx(want)
    facts = checks.mixture_facts(features, vec.chunk_topics(features, model))
    assert {r.is_mixture for r in facts.collect()} == {True}


def test_means_are_checked_without_a_row_for_each_element(spark):
    parts = spark.createDataFrame([("1", [1.0, 2.0]), ("1", [3.0, 6.0]), ("2", [5.0, 5.0])], "book_id string, v array<double>")
    means = spark.createDataFrame([("1", [2.0, 4.0]), ("2", [5.0, 5.1]), ("3", [0.0, 0.0])], "book_id string, m array<double>")
    facts = checks.mean_facts(parts, "v", means.withColumnRenamed("m", "book_v"), "book_v")
    assert "Generate" not in facts._jdf.queryExecution().toString()
    assert {r.book_id: (r["size"], r.is_mean) for r in facts.collect()} == {"1": (2, True), "2": (2, False), "3": (2, False)}


def test_words_beyond_those_of_a_model_are_counted(spark, monkeypatch):
    """No count is lost, however many words there are, and a vocabulary above the broadcast bound gives the same."""
    assert "LIMIT" not in oracle()["vocabulary_counts"]
    chunks = sample(spark).cache()
    rare = spark.createDataFrame([("x", i, [f"word{i % 6000}"]) for i in range(12_000)], "book_id string, chunk_index int, words array<string>")
    rows = chunks.select(*rare.columns).union(rare)
    vocabulary = vec.vocabulary_table(rows)
    want = {r.word: r.n for r in vocabulary.collect()}
    assert len(want) > 6000
    for bound in (1_000_000, 10):
        monkeypatch.setattr("storytide.workspace.broadcast_if_small.__defaults__", (bound,))
        sums = vec.count_vectors(rows, vocabulary).groupBy("place").agg({"n": "sum"}).toDF("place", "s")
        assert {r.word: r.s for r in vocabulary.join(sums, "place").collect()} == want


def test_embeddings_are_checked_with_the_vectors_of_their_words_only(spark, monkeypatch):
    """Chunks of any number of groups and steps meet their vectors; the driver makes no table of them."""
    chunks = sample(spark).cache()
    model = vec.train_word2vec(chunks, vector_size=4, min_count=60)
    embedded = vec.chunk_embeddings(chunks, model).cache()
    first = embedded.orderBy("book_id", "chunk_index").first()
    moved = F.transform("embedding_vector", lambda x, i: x + F.when((i == 3) & (F.col("book_id") == first.book_id), 1e-3).otherwise(0.0))
    monkeypatch.delattr(type(model), "getVectors")
    for groups, words in ((100, 100_000), (3, 7)):
        monkeypatch.setattr(checks, "CHUNKS_PER_GROUP", groups)
        monkeypatch.setattr(checks, "WORDS_PER_STEP", words)
        assert {(r.dimensions, r.is_mean) for r in checks.embedding_facts(chunks, model, embedded).collect()} == {(4, True)}
        wrong = checks.embedding_facts(chunks, model, embedded.withColumn("embedding_vector", moved)).where("not is_mean").collect()
        assert {r.book_id for r in wrong} == {first.book_id}


def test_small_files_share_tasks(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(60):
        (folder / str(i)).write_text(f"text {i}")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.sparkContext.setJobGroup("many files", "many files")
    metadata = spark.createDataFrame([(str(i), "T", "A") for i in range(60)], "book_id string, title string, author string")
    rows = src.load_listed_books(spark, str(folder), metadata)
    assert {r.text for r in rows.collect()} == {f"text {i}" for i in range(60)}
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("many files") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in stages if s) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_books_are_files_named_by_their_ids(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    rows = [(i, None if i == 3 else f"one\r\ntwo {i}", "en", "s") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(path)
    folder = queries._book_files(spark, str(tmp_path))
    found = src.load_books(spark, folder).collect()
    assert {r.book_id: r.text for r in found} == {str(i): f"{text or ''}\n" for i, text, _, _ in rows}


def test_genre_tags_are_computed_once_a_row(spark):
    metadata = spark.createDataFrame([("1", "Horror; Gothic", "Horror tales"), ("2", "gothic", None), ("3", None, "Fantasy")], "book_id string, bookshelves string, subjects string")
    scores = rec.genre_scores(metadata, ["1", "3"])
    assert {r.book_id: dict(r.genres) for r in scores.collect()} == {"2": {"1": 0.5}}
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    # Once for the corpus and once for the queries, which the plan shows twice; not in each condition and lambda that reads the tags.
    assert plan.count("browsing: fiction") == 3


def test_compared_books_are_stored_before_they_are_read_twice(spark, tmp_path):
    rows = [("a", 1, "b", 0.5), ("b", 1, "a", 0.25), ("a", 2, "c", 0.125), ("c", 1, "a", 1.0)]
    spark.createDataFrame(rows, "query_id string, rank int, book_id string, similarity double").write.parquet(str(tmp_path / "compared"))
    given = spark.read.parquet(str(tmp_path / "compared"))
    back, stats = evaluate.reciprocity(given), evaluate.similarity_stats(given)
    assert (back.first().pairs, stats.first().n) == (3, 4)
    for frame in (back, stats):
        assert "/compared" not in frame._jdf.queryExecution().toString()


def test_enriched_rows_are_stored_before_they_are_read_three_times(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "enriched")
    spark.createDataFrame([("1", 3, [0.5], [1.0])], "book_id string, num_chunks int, book_embedding array<double>, book_topics array<double>").write.parquet(path)
    monkeypatch.setattr(queries.corpus, "fit_models", lambda *_, **__: {})
    monkeypatch.setattr(queries.corpus, "enriched_trajectories", lambda *_: spark.read.parquet(path))
    monkeypatch.setattr(queries.models, "chunks", lambda *_: None)
    monkeypatch.setattr(queries, "_with_vector_facts", lambda rows, *_: rows)
    rows = queries.REGISTRY["model_reuse"](spark, DIR)
    assert rows.count() == 1 and not any("/enriched" in f for f in rows.inputFiles())
