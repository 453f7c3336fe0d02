import random

import pytest

from helpers import books, lexicons, score_of, words_of
from storytide.operators.chunking import chunk_text, create_chunks
from storytide.operators.scoring import score_chunks, score_text
from storytide.operators.trajectory import (
    analyze_trajectory,
    dedupe_books,
    explode_arcs,
    normalise_chunks,
    trajectory_points,
    union_query_row,
)
from storytide.schema import CHUNK_SCORES, CHUNKS, EMOTIONS, RATIOS, TRAJECTORY, VERSION, conform
from storytide.plans import corpus as corpus_plan
from storytide.plans.adhoc import input_trajectory
from storytide.plans.corpus import trajectories_of
from helpers import book_row, trajectories

WORDS = ["good", "bad", "storm", "wedding", "isn", "not", "ox", "calm", "the", "positive", "#", "isn't", "good's", "x"]


def corpus(n=40, seed=3):
    rng = random.Random(seed)
    return [(str(i), " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 60)))) for i in range(n)]


def as_map(scores):
    return {(r.book_id, r.chunk_index): tuple(r)[4:] for r in scores.collect()}


def close(got, want):
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key]), key


@pytest.mark.parametrize("small", [True, False])
def test_scores_match_a_second_statement(spark, small):
    lex = lexicons(spark)
    frame = books(spark, corpus())
    pieces = chunk_text(frame, 5)
    want = {(r.book_id, r.chunk_index): score_of(words_of(r.chunk_text)) for r in pieces.collect()}
    scored = score_text(pieces, lex.of_text, small)
    assert [f.name for f in scored.drop(VERSION).schema] == CHUNK_SCORES.names
    assert [f.dataType for f in scored.drop(VERSION).schema] == [f.dataType for f in CHUNK_SCORES]
    close(as_map(scored.drop(VERSION)), want)
    close(as_map(score_chunks(create_chunks(frame, 5), lex.of_words, small).drop(VERSION)), want)


def test_lexicons_are_counted_and_released(spark, monkeypatch):
    lex = lexicons(spark)
    assert lex.small and lex.of_words.is_cached
    table = lex.of_words
    lex.release()
    assert not table.is_cached
    monkeypatch.setattr(corpus_plan, "MAX_BROADCAST_ROWS", 3)
    assert not lex.small


@pytest.mark.parametrize("small", [True, False])
def test_chunks_without_words_are_kept(spark, small):
    lex = lexicons(spark)
    rows = [("1", "t", None, 0, []), ("1", "t", None, 1, None), ("1", "t", None, 2, ["ox", "ox", "#"])]
    got = as_map(score_chunks(spark.createDataFrame(rows, CHUNKS), lex.of_words, small))
    assert got[("1", 0)] == got[("1", 1)] == (0,) * 8 + (0.0,) * 3 + (0,)
    # Given words are scored as they are, short ones included.
    assert got[("1", 2)][0] == 2


@pytest.mark.parametrize("small", [True, False])
def test_copies_of_a_book_do_not_inflate_it(spark, small):
    lex = lexicons(spark)
    rows = corpus(6, seed=5)
    once = score_text(chunk_text(books(spark, rows), 4), lex.of_text, small)
    # One book makes up most of the rows.
    many = score_text(chunk_text(books(spark, rows + [rows[0]] * 50), 4), lex.of_text, small)
    close(as_map(many), as_map(once))


def test_trajectory_invariants(spark):
    lex = lexicons(spark)
    rows = trajectories_of(books(spark, corpus()), lex).collect()
    assert rows
    for row in rows:
        assert sum(row[r] for r in RATIOS) == pytest.approx(1)
        assert [p[0] for p in row.emotion_trajectory] == [float(i) for i in range(row.num_chunks)]
        assert all(sum(p[1:]) == pytest.approx(1) for p in row.emotion_trajectory)


def test_trajectory_values(spark):
    lex = lexicons(spark)
    text = "good storm bad calm"
    pieces = [score_of(words_of(c)) for c in ("good stor", "m bad calm")]
    row = trajectories_of(books(spark, [("1", text)]), lex, 2).first()
    assert row.num_chunks == 2
    for i, e in enumerate(EMOTIONS):
        assert row[f"avg_{e}"] == pytest.approx((pieces[0][i] + pieces[1][i]) / 2)
    for i, d in enumerate(("valence", "arousal", "dominance")):
        assert row[f"avg_{d}"] == pytest.approx((pieces[0][8 + i] + pieces[1][8 + i]) / 2)


def test_no_emotion_anywhere_is_an_even_share(spark):
    row = trajectories_of(books(spark, [("1", "zzzz yyyy wwww")]), lexicons(spark), 3).first()
    assert [row[r] for r in RATIOS] == [0.125] * 8
    assert row.emotion_trajectory[1][1:] == [0.125] * 8


def test_partitioning_does_not_change_scores(spark):
    lex = lexicons(spark)
    frame = books(spark, corpus())
    results = [
        {r.book_id: (r.num_chunks, round(r.avg_joy, 9), round(r.avg_valence, 9)) for r in trajectories_of(f, lex).collect()}
        for f in (frame.coalesce(1), frame.repartition(7), frame.repartition(3, "book_id"))
    ]
    assert results[0] == results[1] == results[2]


def test_long_and_collected_arcs_agree(spark):
    lex = lexicons(spark)
    scores = score_text(chunk_text(books(spark, corpus(8)), 4), lex.of_text)
    names = ["book_id", "chunk_index", *[f"{e}_norm" for e in EMOTIONS]]
    one = sorted(map(tuple, trajectory_points(scores).select(names).collect()))
    two = sorted(map(tuple, explode_arcs(analyze_trajectory(scores)).select(names).collect()))
    assert one == two
    assert normalise_chunks(scores).count() == scores.count()
    assert analyze_trajectory(scores, with_arc=False).where("emotion_trajectory IS NOT NULL").count() == 0


def test_dedupe_keeps_the_most_complete_row(spark):
    rng = random.Random(1)
    full = book_row("1", rng)
    bare = [dict(full, book_embedding=None, book_topics=None, title=f"copy {i:03d}") for i in range(200)]
    topics_only = dict(full, book_embedding=None, title="a")
    other = book_row("2", rng, book_embedding=None)
    frame = trajectories(spark, [*bare, topics_only, full, other]).repartition(6)
    got = {r.book_id: r.title for r in dedupe_books(frame).collect()}
    assert got == {"1": "Title 1", "2": "Title 2"}


def test_conform_and_union(spark):
    rng = random.Random(2)
    narrow = trajectories(spark, [book_row("q", rng)]).drop("book_embedding", "book_topics", "num_chunks")
    both = union_query_row(trajectories(spark, [book_row("1", rng)]), narrow)
    assert both.schema.names == TRAJECTORY.names and both.count() == 2
    assert both.where("book_id = 'q'").first().num_chunks is None
    assert conform(narrow).schema == conform(both).schema


def test_stored_trajectory_is_preferred(spark):
    lex = lexicons(spark)
    frame = books(spark, [("1", "good storm " * 90), ("2", "bad calm " * 90)])
    stored = trajectories(spark, [book_row("1", random.Random(4), num_chunks=99), book_row("3", random.Random(5))])
    rows, scores = input_trajectory(frame, lex, stored)
    assert {r.book_id: r.num_chunks for r in rows.collect()} == {"1": 99, "2": 5}
    assert scores.count() == 10
