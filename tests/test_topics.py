import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from storytide.checks import queries
from storytide.operators import topics as tp
from storytide.operators import vectors as vec

TERMS = 12


def documents(spark, n=200, seed=3):
    """Documents of either the first or the second half of the terms, of many lengths, and some without terms."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        half = range(TERMS // 2) if i % 2 else range(TERMS // 2, TERMS)
        counted = {t: float(rng.randint(1, 9)) for t in half if rng.random() < 0.6} if i % 10 else {}
        rows.append((str(i), i % 3, Vectors.sparse(TERMS, counted)))
    return spark.createDataFrame(rows, ["book_id", "chunk_index", "features"])


def plainly(counted, beta, alpha):
    """One document by the published rules, term by term."""
    topics = len(alpha)
    total = sum(counted.values())
    gamma = [a + total / topics for a in alpha]
    while True:
        theta = [math.exp(float(tp.digamma(np.array([g]))[0])) for g in gamma]
        fresh = list(alpha)
        for term, n in counted.items():
            norm = sum(theta[k] * beta[term][k] for k in range(topics))
            for k in range(topics):
                fresh[k] += n * theta[k] * beta[term][k] / norm
        change = sum(abs(a - b) for a, b in zip(gamma, fresh)) / topics
        gamma = fresh
        if change <= tp.CHANGE:
            return gamma


def test_digamma_and_trigamma():
    assert tp.digamma(np.array([1.0, 0.1, 30.0])) == pytest.approx([-0.5772156649015329, -10.423754940411076, sum(1 / i for i in range(1, 30)) - 0.5772156649015329], abs=1e-9)
    assert tp.trigamma(np.array([1.0, 0.1])) == pytest.approx([math.pi**2 / 6, 101.43329915079276], abs=1e-8)


@pytest.mark.parametrize("block", [1, 40, 1 << 13])
def test_mixtures_are_those_of_each_document_alone(spark, monkeypatch, block):
    monkeypatch.setattr(tp, "BLOCK", block)
    monkeypatch.setattr(tp, "HELD_TERMS", 50 * block)
    rng = np.random.default_rng(5)
    weights, alpha = rng.gamma(0.5, 1, (TERMS, 3)) + 0.01, np.array([0.2, 0.4, 0.1])
    frame = documents(spark).repartition(3)
    got = {r.book_id: r.m for r in tp.mixtures(frame, ["book_id"], weights, alpha, "m").collect()}
    beta = tp.shares_of_words(weights)
    assert len(got) == 200
    for row in frame.collect():
        counted = dict(zip(row.features.indices.tolist(), row.features.values.tolist()))
        want = plainly(counted, beta, alpha)
        assert got[row.book_id] == pytest.approx([g / sum(want) for g in want] if counted else [0.0] * 3, abs=1e-6)


def test_a_vector_is_in_one_mini_batch(spark):
    frame = documents(spark, 2000)
    batches = tp.mini_batches(frame.repartition(3), 42)
    told = sorted((r.batch, r.n) for r in batches.groupBy("batch").agg(F.count("*").alias("n")).collect())
    assert [b for b, _ in told] == list(range(tp.BATCHES)) and sum(n for _, n in told) == 2000 and max(n for _, n in told) < 150
    total = lambda rows: rows.selectExpr("aggregate(counts, 0D, (a, x) -> a + x) AS s").agg(F.sum("s")).first()[0]
    assert total(batches) == total(tp.counted_terms(frame))


def test_an_iteration_reads_its_own_mini_batch(spark, monkeypatch):
    read = []
    frame = type(spark.range(1))
    run = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *a, **k: read.append(self._jdf.queryExecution().toString()) or run(self, *a, **k))
    vec.train_lda(documents(spark), 2, 3)
    assert len(read) == 3
    for turn, plan in enumerate(read):
        assert "PartitionFilters: [isnotnull(batch" in plan and f"= {turn})]" in plan


def test_topics_of_two_kinds_of_documents_are_told_apart(spark):
    frame = documents(spark, 600)
    model = vec.train_lda(frame, 2, 60)
    assert model.topicsMatrix().numRows == TERMS and len(model.describeTopics(4).collect()) == 2
    rows = [r for r in vec.chunk_topics(frame, model).collect() if sum(r.topic_distribution)]
    kind = {r.topic_distribution.index(max(r.topic_distribution)) == int(r.book_id) % 2 for r in rows}
    assert len(kind) == 1 and len(rows) > 500


def test_chunks_are_not_solved_one_by_one(spark):
    """Neither the mixtures nor the likelihood go through Spark's function for one row."""
    plan = queries.REGISTRY["chunk_topics"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "UDF(features" not in plan
