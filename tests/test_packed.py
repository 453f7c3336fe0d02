import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from storytide.checks import models as checks
from storytide.checks import queries
from storytide.operators import means, packed
from storytide.operators import vectors as vec
from storytide.workspace import kept

SF = "/root/testdata/sf0.001"


def chunks(spark, n=300, seed=2):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    rows = [(str(i // 5), i % 5, [rng.choice(words) for _ in range(rng.randint(0, 12))] if i % 50 else None) for i in range(n)]
    return spark.createDataFrame(rows, "book_id string, chunk_index int, words array<string>")


def unpacked(rows):
    for row in rows.collect():
        with pa.ipc.open_stream(row.texts) as stream:
            for one in stream.read_next_batch().to_pylist():
                yield row.part, one


@pytest.mark.parametrize(("held", "size"), [(1 << 22, 1 << 19), (60, 10)])
def test_packed_chunks_are_all_there_and_dealt_evenly(spark, monkeypatch, held, size):
    monkeypatch.setattr(packed, "HELD_WORDS", held)
    monkeypatch.setattr(packed, "ROW_WORDS", size)
    given = chunks(spark).repartition(2)
    for mixed in (None, 7):
        rows = packed.pack(given, 3, ["book_id", "chunk_index"], mixed)
        found = list(unpacked(rows))
        want = sorted((r.book_id, r.chunk_index, tuple(r.words or ())) for r in given.collect())
        assert sorted((c["book_id"], c["chunk_index"], tuple(c["words"] or ())) for _, c in found) == want
        shares = [sum(1 for part, _ in found if part == p) for p in range(3)]
        assert min(shares) > 60
        counted = {(r.part, r.word): r.n for r in packed.words_of_parts(rows).collect()}
        plain = {}
        for part, c in found:
            for w in c["words"] or ():
                plain[part, w] = plain.get((part, w), 0) + 1
        assert counted == plain


def test_what_was_shuffled_for_a_stored_table_is_dropped(spark):
    held = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    before = held()
    assert kept(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "counts").count() == 7
    between = held()
    assert between <= before + 1  # the count's own
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_embeddings_from_a_table_are_means_over_all_words(spark):
    given = chunks(spark)
    known = {f"w{i}": [float(i), -float(i) / 3, 0.5] for i in range(30)}  # the others have no vector
    table = spark.createDataFrame(list(known.items()), "word string, vector array<float>")
    frame = vec.chunk_embeddings(given, table)
    got = {(r.book_id, r.chunk_index): r.embedding_vector for r in frame.collect()}
    assert len(got) == 300
    for row in given.collect():
        words = row.words or []
        sums = np.sum([np.float32(known.get(w, [0, 0, 0])).astype(float) for w in words], axis=0) if words else np.zeros(3)
        assert got[row.book_id, row.chunk_index] == pytest.approx(list(sums / max(1, len(words))), abs=1e-12)
    facts = checks.embedding_facts(given.where("words IS NOT NULL"), table, frame)
    assert {(r.dimensions, r.is_mean) for r in facts.collect()} == {(3, True)}
    moved = frame.withColumn("embedding_vector", F.transform("embedding_vector", lambda x, i: x + F.when(i == 1, 2e-6).otherwise(0.0)))
    assert {r.is_mean for r in checks.embedding_facts(given.where("words IS NOT NULL"), table, moved).collect()} == {False}
    short = frame.withColumn("embedding_vector", F.slice("embedding_vector", 1, 2))
    assert {(r.dimensions, r.is_mean) for r in checks.embedding_facts(given.where("words IS NOT NULL"), table, short).collect()} == {(2, False)}


def test_no_model_of_all_words_comes_to_the_driver(spark, monkeypatch):
    """The queries that embed all chunks keep the vectors as a table."""

    def refuse(*_, **__):
        raise AssertionError("the driver holds all vectors")

    monkeypatch.setattr(vec.Word2VecModel, "load", refuse)
    monkeypatch.setattr(vec.Word2VecModel, "getVectors", refuse)
    checks._kept.pop((spark.sparkContext.applicationId, SF, "word2vec"), None)
    rows = queries.REGISTRY["chunk_embeddings"](spark, SF)
    plan = rows._jdf.queryExecution().toString()
    assert "UDF(words" not in plan and "MapInArrow" in plan
    assert {r.is_mean for r in rows.collect()} == {True}


@pytest.mark.parametrize("held", [1, 50, 1 << 22])
def test_means_by_key_however_rows_are_held(spark, monkeypatch, held):
    monkeypatch.setattr(means, "HELD_NUMBERS", held)
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.randint(0, 1), [rng.random() for _ in range(3)]) for _ in range(400)]
    frame = spark.createDataFrame(rows, "k string, v int, x array<double>").repartition(3)
    got = {(r.k, r.v): r.m for r in vec.vector_mean(frame, ("k", "v"), "x", "m").collect()}
    assert len(got) == len({r[:2] for r in rows})
    for key, mean in got.items():
        assert mean == pytest.approx(list(np.mean([r[2] for r in rows if r[:2] == key], axis=0)))


def test_vectors_are_not_sorted_for_their_means(spark):
    """Spark's own mean of vectors sorts all rows of a task that has more than 128 keys."""
    frame = spark.createDataFrame([("1", 0, [1.0, 2.0])], "book_id string, chunk_index int, embedding_vector array<double>")
    for plan in (vec.book_embedding(frame), vec.book_topics(frame.withColumnRenamed("embedding_vector", "topic_distribution"))):
        text = plan._jdf.queryExecution().toString()
        assert "ObjectHashAggregate" not in text and "SortAggregate" not in text and "MapInArrow" in text


def test_the_size_of_a_vector_need_not_be_looked_up(spark, monkeypatch):
    parts = spark.createDataFrame([("1", [1.0, 2.0]), ("1", [3.0, 6.0])], "book_id string, v array<double>")
    means_of = vec.vector_mean(parts, "book_id", "v", "mean")
    monkeypatch.setattr(type(parts), "first", lambda self: pytest.fail("all vectors were computed for one"))
    assert [(r["size"], r.is_mean) for r in checks.mean_facts(parts, "v", means_of, "mean", 2).collect()] == [(2, True)]
