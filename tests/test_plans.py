"""The physical plans are the intended ones."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from helpers import book_row, lexicons, trajectories
from storytide.operators import joins
from storytide.operators.chunking import chunk_text
from storytide.operators.scoring import score_text
from storytide.plans import corpus, explore, recommend as rec
from storytide.schema import BOOKS, METADATA


def plan_of(frame):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    import random

    rng = random.Random(1)
    path = str(tmp_path_factory.mktemp("plans") / "t")
    trajectories(spark, [book_row(str(i), rng) for i in range(20)]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "b")
    spark.createDataFrame([(str(i), "t", "a", "good storm") for i in range(8)], BOOKS).write.parquet(path)
    return spark.read.parquet(path)


FORBIDDEN = ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas", "FlatMapGroups")


def check(plan):
    assert not [word for word in FORBIDDEN if word in plan]


def test_scoring_broadcasts_the_lexicon_and_shuffles_scores_only(spark, texts):
    lex = lexicons(spark)
    plan = plan_of(score_text(chunk_text(texts), lex.of_text, lex.small))
    check(plan)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(book_id" in line]
    assert len(exchanges) == 1
    assert not [line for line in plan.splitlines() if "Exchange" in line and " text#" in line]


def test_a_large_lexicon_drops_tokens_before_the_shuffle(spark, texts):
    lex = lexicons(spark)
    frame = score_text(chunk_text(texts), lex.of_text, small=False)
    check(plan_of(frame))
    tokens = [below for line, below in below_exchanges(frame) if "token#" in line and "hashpartitioning(book_id" in line]
    assert tokens and all("BroadcastHashJoin [bucket" in below for below in tokens)


def test_books_hashed_by_id_are_scored_without_another_shuffle(spark, texts):
    plan = plan_of(corpus.trajectories_of(texts.repartition(4, "book_id"), lexicons(spark)))
    assert len([line for line in plan.splitlines() if "Exchange hashpartitioning(book_id" in line]) == 1


def test_recommendation_is_one_scan_and_a_top_n(stored):
    plan = plan_of(rec.recommend(stored, "3", unique=True))
    check(plan)
    assert "TakeOrderedAndProject" in plan and "Join" not in plan


def test_unused_signals_are_not_computed(stored):
    plan = plan_of(rec.recommend(stored, "3", unique=True, weights={"feature": 1.0}, with_arc=False))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert any("emotion_trajectory" not in line.split("ReadSchema")[0] for line in scans)


def test_ranks_are_cut_before_the_shuffle(spark, stored):
    metadata = spark.createDataFrame([("1", "t", "a", "en", "x", "y")], METADATA)
    for frame in (
        rec.recommend_batch(stored, ["1", "2"], metadata=metadata),
        rec.preset_comparison(stored, ["1"], metadata),
        explore.vibe_match(stored),
    ):
        plan = plan_of(frame)
        check(plan)
        assert re.search(r"WindowGroupLimit.*Partial", plan) and re.search(r"WindowGroupLimit.*Final", plan)


def exchanges(plan):
    return [line for line in plan.splitlines() if " Exchange " in line]


def below_exchanges(frame):
    """For each exchange the operators and columns below it, as text."""
    lines = plan_of(frame).splitlines()
    out = []
    for i, line in enumerate(lines):
        if " Exchange " not in line:
            continue
        depth = line.index("Exchange")
        below = []
        for other in lines[i + 1 :]:
            start = re.search(r"[A-Za-z*]", other)
            if not start or start.start() <= depth:
                break
            below.append(other)
        out.append((line, "\n".join(below)))
    return out


def test_books_are_shuffled_once_and_pairs_are_not(spark, stored):
    metadata = spark.createDataFrame([("1", "t", "a", "en", "x", "y")], METADATA)
    for frame in (rec.recommend_batch(stored, ["1", "2", "3"], 5, metadata=metadata), rec.preset_comparison(stored, ["1", "2"], metadata)):
        made = [below for _, below in below_exchanges(frame) if "Generate explode(pairs" in below]
        assert made and all("WindowGroupLimit" in below.split("Generate explode(pairs")[0] for below in made)


def test_long_lists_are_cut_in_the_tasks(spark, stored):
    frame = rec.recommend_batch(stored, ["1", "2"], 5000, unique=True)
    made = [below for _, below in below_exchanges(frame) if "Generate explode(pairs" in below]
    assert len(made) == 1 and "MapInArrow" in made[0].split("Generate explode(pairs")[0]
    assert frame.where("query_id = '2'").count() == 19


@pytest.mark.parametrize("bound", [0, 1000])
def test_a_catalogue_of_any_size_moves_no_text(spark, texts, monkeypatch, bound):
    monkeypatch.setattr(joins, "MAX_METADATA_ROWS", bound)
    names = spark.createDataFrame([(str(i), f"T{i}", "a") for i in range(4)], "book_id string, title string, author string")
    frame = corpus.catalogue_trajectories(texts, names, lexicons(spark))
    assert {r.title for r in frame.collect()} == {"T0", "T1", "T2", "T3"}
    sized = joins.join_metadata(texts, names, lambda b: b.select("book_id", F.length("text").alias("n")))
    for each in (frame, sized):
        check(plan_of(each))
        for line, below in below_exchanges(each):
            node = below.splitlines()[0]
            assert "text#" not in line and "text#" not in node, node


def test_query_book_filter_reaches_the_scan(stored):
    plan = plan_of(rec.recommend(stored, "3"))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(book_id,3\)", plan)


def test_searches_are_top_n(stored):
    for frame in (explore.match_preferences(stored, {"joy": 0.5}), explore.top_by_emotion(stored, "joy")):
        plan = plan_of(frame)
        check(plan)
        assert "TakeOrderedAndProject" in plan


def test_superlatives_are_one_aggregate(stored):
    plan = plan_of(explore.superlatives(stored))
    check(plan)
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
