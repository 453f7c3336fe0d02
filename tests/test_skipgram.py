import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from storytide.checks import models as checks
from storytide.checks import queries
from storytide.operators import skipgram
from storytide.operators import vectors as vec

SF = "/root/testdata/sf0.001"


def planted(spark, rows=120):
    rng = random.Random(4)
    words = ["whale", "ship", "storm", "letter", "dance", "clue"]
    texts = [(f"{i}", 0, [rng.choice(words) for _ in range(60)]) for i in range(rows)]
    return checks.planted_twins_of(spark.createDataFrame(texts, "book_id string, chunk_index int, words array<string>"))


@pytest.mark.parametrize("partitions", [1, 3])
def test_twins_are_found_by_any_number_of_tasks(spark, partitions):
    rows, chosen = planted(spark)
    model = vec.train_word2vec(rows.coalesce(2), vector_size=20, max_iter=5, partitions=partitions)
    asked = {**{w: f"{w}_twin" for w in chosen}, **{f"{w}_twin": w for w in chosen}}
    assert dict(checks.nearest_words(model, list(asked))) == asked


def test_words_are_counted_over_all_parts(spark):
    rows = [["five", "whale"]] * 5 + [["four", "whale"]] * 4 + [[], None, ["once"]]
    frame = spark.createDataFrame([(r,) for r in rows], "words array<string>").coalesce(1)
    vectors = vec.word_vectors(frame, vector_size=4, min_count=5, partitions=4)
    assert {r.word: len(r.vector) for r in vectors.collect()} == {"five": 4, "whale": 4}
    with pytest.raises(ValueError):
        vec.word_vectors(frame, vector_size=4, min_count=50)


def test_same_seed_gives_the_same_vectors(spark):
    rows = planted(spark, 40)[0].coalesce(2).cache()
    one, two, other = ({r.word: r.vector for r in vec.word_vectors(rows, 8, seed=s, partitions=3, max_iter=2).collect()} for s in (1, 1, 2))
    assert one == two and one != other


def test_words_of_other_sentences_are_no_neighbours(spark):
    """Words that stand alone keep their first vectors, whatever stands in the next chunk; in one chunk they move."""
    words = ["whale", "ship", "storm"] * 40
    alone = spark.createDataFrame([([w],) for w in words], "words array<string>").coalesce(1)
    again, beside = alone.union(alone), spark.createDataFrame([(words,)], "words array<string>")
    first, more, moved = ({r.word: r.vector for r in vec.word_vectors(f, 8).collect()} for f in (alone, again, beside))
    assert first == more and all(first[w] != moved[w] for w in first)
    assert all(abs(x) <= 0.5 / 8 for v in first.values() for x in v)


def test_means_of_words_that_lie_in_two_batches():
    rows = [("a", [1.0, 2.0]), ("a", [3.0, 4.0]), ("a", [5.0, 9.0]), ("b", [1.0, 1.0]), ("c", [0.0, 2.0]), ("c", [4.0, 2.0])]
    schema = pa.schema([("word", pa.string()), ("vectors", pa.list_(pa.float32()))])
    for size in (1, 2, 4, 6):
        batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[i : i + size]], schema) for i in range(0, 6, size)]
        got = {r["word"]: r["vectors"] for b in skipgram.averager()(iter(batches)) for r in b.to_pylist()}
        assert got == {"a": [3.0, 5.0], "b": [1.0, 1.0], "c": [2.0, 2.0]}


def test_the_driver_holds_no_vectors_of_the_fit(spark):
    plan = contract.queries()["word2vec_fit"](spark, SF)._jdf.queryExecution().toString()
    assert "LocalTableScan" not in plan and "LocalRelation" not in plan and "FileScan" in plan


def test_twins_are_trained_in_all_tasks(spark, monkeypatch):
    seen, train = [], vec.train_word2vec
    monkeypatch.setattr(vec, "train_word2vec", lambda *a, **k: seen.append(k.get("partitions", 1)) or train(*a, **k))
    rows = {r.word: r.nearest for r in queries.REGISTRY["word2vec_twins"](spark, SF).collect()}
    assert seen == [spark.sparkContext.defaultParallelism] and len(rows) == 16
    assert all(rows[nearest] == word for word, nearest in rows.items())
