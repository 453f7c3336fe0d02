import random

import pytest

from helpers import book_row, cosine, signals_of, trajectories
from storytide.plans import recommend as rec
from storytide.schema import AVERAGES, METADATA

METADATA_ROWS = [
    ("0", "Gothic Fiction; Best", "Horror tales"),
    ("1", "Gothic Fiction", None),
    ("2", None, "horror; Fantasy"),
    ("3", "Other", "Philosophy"),
    ("4", None, None),
    ("99", "Gothic Fiction; Best", "Horror tales"),
]


def sample(n=12, seed=7):
    rng = random.Random(seed)
    rows = [book_row(str(i), rng) for i in range(n)]
    rows[3].update(book_embedding=None, book_topics=None)
    rows[4].update(book_embedding=[0.0] * 6, book_topics=[0.0] * 4)
    rows[5].update(book_embedding=[1.0, 2.0], book_topics=[1.0, 2.0])
    rows[6].update(emotion_trajectory=rows[6]["emotion_trajectory"][:1])
    rows[7].update(emotion_trajectory=None, ratio_joy=None, avg_valence=None)
    rows[8] = dict(rows[0], book_id="8")
    return rows


def metadata(spark):
    rows = [(i, f"Title {i}", "Author", "en", shelves, subjects) for i, shelves, subjects in METADATA_ROWS]
    return spark.createDataFrame(rows, METADATA)


def genre(a, b):
    tags = {
        "0": {"gothic fiction", "best", "horror"}, "1": {"gothic fiction"}, "2": {"horror", "fantasy"},
        "3": {"other"}, "99": {"gothic fiction", "best", "horror"},
    }
    one, two = tags.get(a, set()), tags.get(b, set())
    return len(one & two) / len(one | two) if one and two else 0.0


@pytest.mark.parametrize("query", ["0", "3", "4", "5", "6", "7"])
def test_signals_match_a_second_statement(spark, query):
    rows = {r["book_id"]: r for r in sample()}
    got = rec.pair_signals(trajectories(spark, list(rows.values())), [query]).collect()
    assert {r.book_id for r in got} == set(rows) - {query}
    for row in got:
        for name, value in signals_of(rows[row.book_id], rows[query]).items():
            assert row[f"{name}_similarity"] == pytest.approx(value, abs=1e-12), (name, row.book_id)
            assert -1e-12 <= row[f"{name}_similarity"] <= 1 + 1e-12


def test_copy_of_the_query_is_identical(spark):
    got = rec.feature_similarity(trajectories(spark, sample()), "0").where("book_id = '8'").first()
    assert got.feature_similarity == 1.0


def test_signals_are_symmetric(spark):
    frame = trajectories(spark, sample())
    names = [f"{s}_similarity" for s in rec.SIGNALS[:4]]
    got = {(r.query_id, r.book_id): [r[n] for n in names] for r in rec.pair_signals(frame, [str(i) for i in range(12)]).collect()}
    assert len(got) == 12 * 11
    for (a, b), values in got.items():
        assert values == pytest.approx(got[(b, a)])


def test_arc_shape_ignores_positions(spark):
    rows = {r["book_id"]: r for r in sample()}
    got = rec.trajectory_similarity(trajectories(spark, list(rows.values())), "0", arc="shape").collect()
    for row in got:
        arcs = [[x for p in (rows[i]["emotion_trajectory"] or []) for x in p[1:]] for i in ("0", row.book_id)]
        length = max(map(len, arcs))
        want = cosine(*[a + [0.0] * (length - len(a)) for a in arcs])
        assert row.trajectory_similarity == pytest.approx(want)


def test_genre_similarity(spark):
    got = {r.book_id: r.genre_similarity for r in rec.genre_similarity(metadata(spark), "0").collect()}
    assert got == pytest.approx({i: genre("0", i) for i in ("1", "2", "3", "4", "99")})
    assert rec.genre_similarity(metadata(spark), "4").count() == 0
    assert rec.genre_similarity(metadata(spark), "nobody").count() == 0


def brute_force(rows, query, weights, top_n=10, genres=True):
    by_id = {r["book_id"]: r for r in rows}
    total = sum(weights.values())
    scored = []
    for i, row in by_id.items():
        if i != query:
            signals = dict(signals_of(row, by_id[query]), genre=genre(query, i) if genres else 0.0)
            scored.append((sum(weights[s] / total * signals[s] for s in weights), i))
    return sorted(scored, key=lambda s: (-round(s[0], 9), s[1]))[:top_n]


@pytest.mark.parametrize("preset", [*rec.PRESETS, "unknown", None])
def test_recommend(spark, preset):
    rows = sample()
    got = rec.recommend(trajectories(spark, rows), "0", 5, preset=preset, metadata=metadata(spark)).collect()
    want = brute_force(rows, "0", rec.weight_preset(preset), 5)
    assert [r.book_id for r in got] == [i for _, i in want]
    assert [r.similarity for r in got] == pytest.approx([s for s, _ in want])
    assert "99" not in [r.book_id for r in got]


def test_result_schema(spark):
    frame = trajectories(spark, sample())
    want = ["book_id", "title", "author", "similarity", *AVERAGES, "emotion_trajectory"]
    assert rec.recommend(frame, "0").columns == want
    missing = rec.recommend(frame, "nobody", metadata=metadata(spark))
    assert missing.columns == want and missing.count() == 0


def test_own_weights_without_metadata(spark):
    rows = sample()
    weights = {"feature": 2.0, "trajectory": 0.0, "embedding": 1.0, "topic": 0.0, "genre": 0.0}
    got = rec.recommend(trajectories(spark, rows), "0", 20, weights=weights, metadata=metadata(spark)).collect()
    want = brute_force(rows, "0", weights, 20, genres=False)
    assert [r.book_id for r in got] == [i for _, i in want]
    assert [r.similarity for r in got] == pytest.approx([s for s, _ in want])


def test_genre_alone(spark):
    rows = sample()
    got = rec.recommend_batch(trajectories(spark, rows), ["0"], 20, weights={"genre": 1.0}, metadata=metadata(spark)).collect()
    want = brute_force(rows, "0", {"genre": 1.0}, 20)
    assert [(r.book_id, r.similarity) for r in sorted(got, key=lambda r: r["rank"])] == [(i, s) for s, i in want]


def test_only_books_that_share_a_tag_are_scored(spark):
    got = {r.book_id: r.genres for r in rec.genre_scores(metadata(spark), ["0", "3", "4", "nobody"]).collect()}
    assert got == {i: {"0": genre("0", i)} for i in ("1", "2", "99")}


def test_many_copies_of_one_book(spark):
    rows = sample()
    bare = [dict(rows[2], title=f"copy {i}", book_embedding=None, book_topics=None, avg_joy=i / 1000) for i in range(400)]
    frame = trajectories(spark, rows + bare).repartition(5)
    got = rec.recommend_batch(frame, ["0", "2"], 5).collect()
    for query in ("0", "2"):
        want = brute_force(rows, query, rec.weight_preset(), 5, genres=False)
        hits = [r for r in got if r.query_id == query]
        assert [r.book_id for r in sorted(hits, key=lambda r: r["rank"])] == [i for _, i in want]
    single = [r.book_id for r in rec.recommend(frame, "2", 5).collect()]
    assert single == [i for _, i in brute_force(rows, "2", rec.weight_preset(), 5, genres=False)]


@pytest.mark.parametrize("unknown", [1, 70])
def test_batch_equals_single_queries_whatever_the_number_of_ids(spark, unknown):
    rows = sample()
    ids = ["0", "7", *[str(i) for i in range(8)], *[f"unknown {i}" for i in range(unknown)], "7", "nobody"]
    got = rec.recommend_batch(trajectories(spark, rows), ids, 4, metadata=metadata(spark), unique=True).collect()
    for query in [str(i) for i in range(8)]:
        hits = sorted((r for r in got if r.query_id == query), key=lambda r: r["rank"])
        want = brute_force(rows, query, rec.weight_preset(), 4)
        assert [r.book_id for r in hits] == [i for _, i in want]
        assert [r["rank"] for r in hits] == [1, 2, 3, 4]
    assert "nobody" not in {r.query_id for r in got}


def test_renormalized_weights(spark):
    rows = sample()
    by_id = {r["book_id"]: r for r in rows}
    got = {r.book_id: r.similarity for r in rec.recommend(trajectories(spark, rows), "0", 20, renormalize=True).collect()}
    weights = rec.weight_preset()
    signals = signals_of(by_id["3"], by_id["0"])
    held = weights["feature"] + weights["trajectory"]
    want = (weights["feature"] * signals["feature"] + weights["trajectory"] * signals["trajectory"]) / held
    assert got["3"] == pytest.approx(want)


def test_minmax_similarity(spark):
    rows = [r for r in sample() if r["avg_valence"] is not None]
    for r in rows:
        r["avg_fear"] = 2.5  # the same everywhere
    others = [r for r in rows if r["book_id"] != "0"]
    low = {c: min(r[c] for r in others) for c in AVERAGES}
    high = {c: max(r[c] for r in others) for c in AVERAGES}

    def scaled(row, c):
        return (row[c] - low[c]) / (high[c] - low[c]) if high[c] > low[c] else 0.5

    got = rec.feature_similarity_minmax(trajectories(spark, rows), "0").collect()
    assert len(got) == len(others)
    by_id = {r["book_id"]: r for r in rows}
    for row in got:
        gaps = [scaled(by_id[row.book_id], c) - scaled(by_id["0"], c) for c in AVERAGES]
        assert row.feature_similarity == pytest.approx(1 / (1 + sum(g * g for g in gaps) ** 0.5))
    assert rec.feature_similarity_minmax(trajectories(spark, rows), "nobody").count() == 0


def test_preset_comparison(spark):
    rows = sample()
    got = rec.preset_comparison(trajectories(spark, rows), ["0"], metadata(spark), 3).collect()
    for preset in rec.PRESETS:
        hits = sorted((r for r in got if r.preset == preset), key=lambda r: r["rank"])
        assert [r.book_id for r in hits] == [i for _, i in brute_force(rows, "0", rec.weight_preset(preset), 3)]
