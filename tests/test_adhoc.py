import random

import pytest

from helpers import book_row, lexicons, trajectories
from storytide.plans.adhoc import analyze_input, recommend_for

TEXT = "good storm wedding bad calm whale " * 60


@pytest.fixture
def library(tmp_path):
    (tmp_path / "books").mkdir()
    (tmp_path / "books" / "7").write_text("*** START ***" + TEXT)
    (tmp_path / "catalogue.csv").write_text(
        "Etext Number,Title,Authors,Language,Bookshelves,Subjects\n7,Seven,Ann,en,,\n8,Eight,Bob,en,,\n"
    )
    return {"books_path": str(tmp_path / "books"), "metadata_path": str(tmp_path / "catalogue.csv")}


def test_book_of_the_catalogue(spark, library):
    got = analyze_input(spark, lexicons(spark), book_id=" 7 ", num_topics=2, **library)
    row = got.trajectory.first()
    assert (row.book_id, row.title, row.author, row.num_chunks) == ("7", "Seven", "Ann", 5)
    assert got.chunk_scores.count() == 5
    assert sum(got.topics.first().book_topics) == pytest.approx(1)
    stored = trajectories(spark, [book_row("7", random.Random(1), num_chunks=20)])
    assert analyze_input(spark, lexicons(spark), book_id="7", stored=stored, **library).trajectory.first().num_chunks == 20


def test_unknown_input(spark, library):
    with pytest.raises(ValueError):
        analyze_input(spark, lexicons(spark), book_id="9", **library)
    with pytest.raises(ValueError):
        analyze_input(spark, lexicons(spark))
    with pytest.raises(Exception, match="(?i)path"):
        analyze_input(spark, lexicons(spark), book_id="8", **library)


def test_text_file_against_a_corpus(spark, tmp_path):
    path = tmp_path / "a_story.txt"
    path.write_text(TEXT)
    got = analyze_input(spark, lexicons(spark), text_path=str(path))
    assert got.topics is None and got.trajectory.first().title == "a story"
    rng = random.Random(3)
    corpus = trajectories(spark, [book_row(str(i), rng) for i in range(6)])
    assert recommend_for(corpus, got.trajectory, "a_story.txt", 4).count() == 4
    few = recommend_for(corpus, got.trajectory, "a_story.txt", limit=2)
    assert {r.book_id for r in few.collect()} == {"0", "1"}
