import random

import pytest
from pyspark.sql import functions as F

from helpers import books, lexicons
from storytide.checks import models as checks
from storytide.operators import vectors as vec
from storytide.operators.chunking import create_chunks
from storytide.plans import corpus
from storytide.sources import tables
from storytide.streaming import ingest as st


def sample(n=30, seed=9):
    rng = random.Random(seed)
    themes = [["whale", "ship", "harpoon", "storm"], ["wedding", "dance", "letter", "good"], ["murder", "clue", "bad"]]
    return [(str(i), " ".join(rng.choice(themes[i % 3]) for _ in range(120))) for i in range(n)]


def test_vector_mean(spark):
    rng = random.Random(1)
    rows = [(str(i % 3), None if i % 7 == 0 else [rng.random() for _ in range(4)]) for i in range(60)] + [("x", None)]
    frame = spark.createDataFrame(rows, "k string, v array<double>")
    got = {r.k: r.m for r in vec.vector_mean(frame.repartition(5), "k", "v", "m").collect()}
    assert set(got) == {"0", "1", "2"}
    for key, mean in got.items():
        mine = [v for k, v in rows if k == key and v]
        assert mean == pytest.approx([sum(c) / len(mine) for c in zip(*mine)])


def test_topic_rank(spark):
    frame = spark.createDataFrame([("1", [0.1, 0.5, 0.1, 0.3]), ("2", None)], "book_id string, book_topics array<double>")
    got = [(r["rank"], r.topic, r.weight) for r in vec.topic_rank(frame, 3).orderBy("rank").collect()]
    assert got == [(1, 2, 0.5), (2, 4, 0.3), (3, 1, 0.1)]


def test_models_fit_save_load_and_apply(spark, tmp_path):
    frame = books(spark, sample())
    models = corpus.fit_models(frame, 20, num_chunks=4, vector_size=8, num_topics=3, lda_iterations=5)
    assert set(models) == {"word2vec", "count_vectorizer", "lda"}
    tables.save_models({**models, "absent": None}, str(tmp_path / "m"))
    loaded = tables.load_models(spark, str(tmp_path / "m"))
    assert set(loaded) == set(models)
    lex = lexicons(spark)
    one = {r.book_id: r for r in corpus.enriched_trajectories(frame, lex, models, 4).collect()}
    two = {r.book_id: r for r in corpus.enriched_trajectories(frame, lex, loaded, 4).collect()}
    assert len(one) == 30
    for book_id, row in one.items():
        assert len(row.book_embedding) == 8
        assert sum(row.book_topics) == pytest.approx(1)
        assert row.book_embedding == pytest.approx(two[book_id].book_embedding, abs=1e-6)
        assert row.book_topics == pytest.approx(two[book_id].book_topics, abs=1e-6)


def test_same_seed_gives_the_same_topics(spark):
    chunks = create_chunks(books(spark, sample(12)), 2).coalesce(1).cache()
    features = vec.topic_features(chunks, vec.fit_vocabulary(chunks)).cache()
    mixtures = []
    for _ in range(2):
        topics = vec.chunk_topics(features, vec.train_lda(features, 3, 5))
        mixtures.append({(r.book_id, r.chunk_index): r.topic_distribution for r in topics.collect()})
    for key, mixture in mixtures[0].items():
        assert mixture == pytest.approx(mixtures[1][key])


def test_chunk_embedding_is_the_mean_over_all_words(spark):
    chunks = create_chunks(books(spark, sample(12)), 2)
    model = vec.train_word2vec(chunks, vector_size=4, min_count=5)
    known = {r.word: list(r.vector) for r in model.getVectors().collect()}
    given = spark.createDataFrame([("1", 0, ["whale", "ship", "unheard"]), ("1", 1, [])], "book_id string, chunk_index int, words array<string>")
    got = {r.chunk_index: r.embedding_vector for r in vec.chunk_embeddings(given, model).collect()}
    assert got[0] == pytest.approx([(a + b) / 3 for a, b in zip(known["whale"], known["ship"])], abs=1e-6)
    assert got[1] == [0.0] * 4


def test_models_can_be_skipped(spark):
    frame = books(spark, sample(9))
    models = corpus.fit_models(frame, 9, num_chunks=2, vector_size=4, skip_topics=True)
    assert set(models) == {"word2vec"}
    row = corpus.enriched_trajectories(frame, lexicons(spark), models, 2).first()
    assert row.book_topics is None and len(row.book_embedding) == 4
    assert tables.load_models(spark, "/no/such/place") == {}


def as_rows(frame):
    return sorted(str(r) for r in frame.select("book_id", "num_chunks", F.round("avg_joy", 9), F.round("avg_valence", 9)).collect())


def test_streaming_equals_batch_and_adds_nothing_twice(spark, tmp_path):
    lex, rows = lexicons(spark), sample(20)
    source, sink, progress = (str(tmp_path / n) for n in ("in", "out", "cp"))
    books(spark, rows[:12]).repartition(4).write.parquet(source)
    st.ingest(spark, source, sink, progress, lex, num_chunks=4, files_per_batch=1)
    st.ingest(spark, source, sink, progress, lex, num_chunks=4, files_per_batch=1)
    # Later files bring new books, books that are stored already, and a repeated one.
    books(spark, rows[8:] + rows[15:16]).repartition(2).write.mode("append").parquet(source)
    st.ingest(spark, source, sink, progress, lex, num_chunks=4, files_per_batch=2)
    want = corpus.trajectories_of(books(spark, rows), lex, 4)
    assert as_rows(tables.load_trajectories(spark, sink)) == as_rows(want)


def test_replayed_batch_adds_only_what_is_missing(spark, tmp_path):
    lex, rows, sink = lexicons(spark), sample(10), str(tmp_path / "out")
    st.append_batch(books(spark, rows[:4]), sink, lex, num_chunks=3)
    st.append_batch(books(spark, rows), sink, lex, num_chunks=3)
    st.append_batch(books(spark, rows), sink, lex, num_chunks=3)
    assert as_rows(tables.load_trajectories(spark, sink)) == as_rows(corpus.trajectories_of(books(spark, rows), lex, 3))


def test_models_in_the_stream_and_a_replay(spark, tmp_path, monkeypatch):
    lex, rows = lexicons(spark), sample(12)
    models = corpus.fit_models(books(spark, rows), 12, num_chunks=3, vector_size=4, num_topics=2, lda_iterations=2)
    source, sink, progress = (str(tmp_path / n) for n in ("in", "out", "cp"))
    books(spark, rows).repartition(3).write.parquet(source)
    st.ingest(spark, source, sink, progress, lex, models, num_chunks=3, files_per_batch=1)
    stored = {r.book_id: r for r in tables.load_trajectories(spark, sink).collect()}
    want = {r.book_id: r for r in corpus.enriched_trajectories(books(spark, rows), lex, models, 3).collect()}
    assert set(stored) == set(want)
    for book_id, row in want.items():
        assert stored[book_id].book_embedding == pytest.approx(row.book_embedding)
        assert stored[book_id].book_topics == pytest.approx(row.book_topics)
    # A batch whose marker is there is not read again, whatever it holds; another stream's marker does not count.
    marker = st.commit_path(sink, progress, 0)
    assert tables.exists(spark, marker)
    st.append_batch(books(spark, [("new", "good storm")]), sink, lex, models, 3, marker)
    assert tables.load_trajectories(spark, sink).count() == 12
    st.append_batch(books(spark, [("new", "good storm")]), sink, lex, models, 3, st.commit_path(sink, "elsewhere", 0))
    assert tables.load_trajectories(spark, sink).count() == 13


def test_texts_are_cut_once_for_all_models(spark, tmp_path):
    frame = books(spark, sample(6))
    frame.write.parquet(str(tmp_path / "texts"))
    models = corpus.fit_models(frame, 6, num_chunks=2, vector_size=4, num_topics=2, lda_iterations=1)
    plan = corpus.enriched_trajectories(spark.read.parquet(str(tmp_path / "texts")), lexicons(spark), models, 2)._jdf.queryExecution().toString()
    assert "/texts" not in plan and "/chunks" in plan


def test_versions_have_vectors_of_their_own(spark):
    one, two = "whale ship " * 30, "wedding dance letter " * 20
    frame = books(spark, [("1", one), ("1", two), ("1", one), ("2", one)])
    models = corpus.fit_models(books(spark, sample(30)), 30, num_chunks=2, vector_size=4, num_topics=2, lda_iterations=2)
    rows = corpus.enriched_trajectories(frame, lexicons(spark), models, 2).collect()
    assert sorted(r.book_id for r in rows) == ["1", "1", "2"]
    two_of_one = [r for r in rows if r.book_id == "1"]
    same = next(r for r in rows if r.book_id == "2")
    assert sum(r.book_embedding == pytest.approx(same.book_embedding) for r in two_of_one) == 1


def test_vocabulary_is_counted_and_ordered(spark):
    chunks = spark.createDataFrame([(["b", "a", "b"],), (["a", "c"],), (["c", "b", "d", "d", "d"],), ([],)], "words array<string>").repartition(2)
    rows = vec.vocabulary_table(chunks, 2).orderBy("place").collect()
    assert [(r.word, r.n, r.chunks, r.place) for r in rows] == [("b", 3, 2, 0), ("a", 2, 2, 1), ("c", 2, 2, 2)]
    assert {r.word for r in vec.vocabulary_table(chunks, 0.2).collect()} == {"a", "b", "c", "d"}
    assert vec.fit_vocabulary(chunks, 2).vocabulary == ["b", "a"] and vec.fit_vocabulary(chunks, 9, 1.0).vocabulary == ["b", "d", "a", "c"]
    for size, least in ((1 << 19, 2.0), (10, 9.0)):
        with pytest.raises(ValueError):
            vec.fit_vocabulary(chunks, size, least)


def test_twins_are_found_by_learnt_vectors_only(spark):
    rng = random.Random(4)
    words = ["whale", "ship", "storm", "letter", "dance", "clue"]
    rows = [(f"{i}", 0, [rng.choice(words) for _ in range(60)]) for i in range(60)]
    chunks = spark.createDataFrame(rows, "book_id string, chunk_index int, words array<string>")
    planted, chosen = checks.planted_twins_of(chunks)
    model = vec.train_word2vec(planted.coalesce(1), vector_size=20, max_iter=5)
    asked = [*chosen, *(f"{w}_twin" for w in chosen)]
    want = {w: f"{w}_twin" for w in chosen} | {f"{w}_twin": w for w in chosen}
    assert dict(checks.nearest_words(model, asked)) == want
    alone = planted.select(F.explode("words").alias("word")).select(F.array("word").alias("words"))
    assert dict(checks.nearest_words(vec.train_word2vec(alone.coalesce(1), vector_size=20), asked)) != want


def test_checks_of_models_fail_on_wrong_vectors(spark):
    chunks = create_chunks(books(spark, sample(12)), 2).cache()
    model = vec.train_word2vec(chunks, vector_size=8)
    embedded = vec.chunk_embeddings(chunks, model)
    wrong = embedded.withColumn("embedding_vector", F.reverse("embedding_vector"))
    facts = lambda rows: {r.is_mean for r in checks.embedding_facts(chunks, model, rows).collect()}
    assert facts(embedded) == {True} and False in facts(wrong)

    features = vec.topic_features(chunks, vec.fit_vocabulary(chunks))
    mixed = vec.chunk_topics(features, vec.train_lda(features, 3, 5))
    facts = lambda rows: {r.is_mixture for r in checks.mixture_facts(features, rows).collect()}
    assert facts(mixed) == {True}
    assert facts(mixed.withColumn("topic_distribution", F.array(*[F.lit(1 / 3)] * 3))) == {False}
    assert facts(mixed.withColumn("topic_distribution", F.transform("topic_distribution", lambda x: x / 2))) == {False}

    means = vec.book_topics(mixed)
    facts = lambda rows: {r.is_mean for r in checks.mean_facts(mixed, "topic_distribution", rows, "book_topics").collect()}
    assert facts(means) == {True} and False in facts(means.withColumn("book_topics", F.reverse("book_topics")))


def test_models_are_fitted_without_the_given_stop_words(spark):
    frame = books(spark, sample(12))
    models = corpus.fit_models(frame, 12, num_chunks=2, num_topics=2, lda_iterations=1, skip_embeddings=True, stop_words=["whale"])
    assert "whale" not in models["count_vectorizer"].vocabulary and "ship" in models["count_vectorizer"].vocabulary


def test_books_of_the_sink_are_not_scored_again(spark, tmp_path, monkeypatch):
    lex, rows, sink = lexicons(spark), sample(10), str(tmp_path / "out")
    scored, score = [], st.enriched_trajectories

    def counted(batch, *args):
        scored.append(batch.count())
        return score(batch, *args)

    monkeypatch.setattr(st, "enriched_trajectories", counted)
    for part in (rows[:4], rows[2:], rows):
        st.append_batch(books(spark, part), sink, lex, num_chunks=3)
    assert scored == [4, 6, 0]
    assert as_rows(tables.load_trajectories(spark, sink)) == as_rows(corpus.trajectories_of(books(spark, rows), lex, 3))


def test_a_batch_of_few_files_is_scored_by_all_cores(spark, tmp_path, monkeypatch):
    lex, rows, sink = lexicons(spark), sample(40), str(tmp_path / "out")
    parts, score = [], st.enriched_trajectories

    def counted(batch, *args):
        parts.append(batch.rdd.getNumPartitions())
        return score(batch, *args)

    monkeypatch.setattr(st, "enriched_trajectories", counted)
    source = str(tmp_path / "in")
    books(spark, rows).coalesce(1).write.parquet(source)
    st.ingest(spark, source, sink, str(tmp_path / "cp"), lex, num_chunks=3)
    assert parts == [2 * spark.sparkContext.defaultParallelism]
    st.append_batch(books(spark, rows + sample(44)[40:]).repartition(50), sink, lex, num_chunks=3)
    assert parts[1] >= spark.sparkContext.defaultParallelism
    assert as_rows(tables.load_trajectories(spark, sink)) == as_rows(corpus.trajectories_of(books(spark, sample(44)), lex, 3))
