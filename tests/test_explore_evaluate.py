import random
import statistics

import pytest

from helpers import book_row, trajectories
from storytide.plans import evaluate as ev
from storytide.plans import explore as ex
from storytide.plans.recommend import recommend_batch
from storytide.schema import EMOTIONS, METADATA


def sample(n=30, seed=11):
    rng = random.Random(seed)
    return [book_row(str(i), rng) for i in range(n)]


def preference_score(rows, row, levels, unit=False):
    total = 0.0
    for e, level in levels.items():
        values = [r[f"avg_{e}"] for r in rows]
        low, high = min(values), max(values)
        want = level if unit else (level - low) / (high - low)
        total += ((row[f"avg_{e}"] - low) / (high - low) - want) ** 2
    return 1 / (1 + total**0.5)


@pytest.mark.parametrize("unit", [False, True])
def test_preferences(spark, unit):
    rows = sample()
    levels = {"joy": 0.9, "fear": 0.2}
    given = {"Joy": 0.9, "FEAR": 0.2, "trust": 0.0, "boredom": 1.0}
    got = ex.match_preferences(trajectories(spark, rows), given, 7, scale="unit" if unit else "parity").collect()
    want = sorted(((preference_score(rows, r, levels, unit), r["book_id"]) for r in rows), key=lambda s: (-s[0], s[1]))[:7]
    assert [r.book_id for r in got] == [i for _, i in want]
    assert [r.match_score for r in got] == pytest.approx([s for s, _ in want])


def test_no_preference_gives_no_match(spark):
    frame = trajectories(spark, sample(3))
    none = ex.match_preferences(frame, {"joy": 0.0, "boredom": 1.0})
    assert none.count() == 0
    assert none.columns == ex.match_preferences(frame, {"joy": 1.0}).columns


def test_emotion_that_is_the_same_everywhere(spark):
    rows = [dict(r, avg_joy=0.0) for r in sample(3)]
    got = ex.match_preferences(trajectories(spark, rows), {"joy": 0.7}).collect()
    assert [r.match_score for r in got] == [1.0] * 3


def test_vibes(spark):
    rows = sample()
    got = ex.vibe_match(trajectories(spark, rows), 4).collect()
    for vibe in ex.VIBES:
        levels = {e: v for e, v in ex.vibe_levels(vibe).items() if v > 0}
        want = sorted(((preference_score(rows, r, levels), r["book_id"]) for r in rows), key=lambda s: (-s[0], s[1]))[:4]
        hits = sorted((r for r in got if r.vibe == vibe), key=lambda r: r["rank"])
        assert [r.book_id for r in hits] == [i for _, i in want]


def test_title_search(spark):
    titles = ["The Whale", "the whale", "50% Off", "A_b", "Axb", None]
    frame = spark.createDataFrame([(str(i), t, "a", "en", None, None) for i, t in enumerate(titles)], METADATA)

    def found(*args, **kw):
        return [r.book_id for r in ex.title_search(frame, *args, **kw).collect()]

    assert found("WHALE") == ["0", "1"]
    assert found("whale", case_sensitive=True) == ["1"]
    assert found("A_b", case_sensitive=True) == ["3", "4"]
    assert found("a_b") == ["3"]
    assert found("%") == ["2"]
    assert found("") == found(None) == []
    assert found("e", limit=1) == ["0"]


def test_rankings(spark):
    rows = sample()
    frame = trajectories(spark, rows)
    for emotion in EMOTIONS:
        got = [r.book_id for r in ex.top_by_emotion(frame, emotion.title(), 5).collect()]
        assert got == [r["book_id"] for r in sorted(rows, key=lambda r: -r[f"avg_{emotion}"])[:5]]
    with pytest.raises(ValueError):
        ex.top_by_emotion(frame, "boredom")
    got = {r.label: (r.title, r.value) for r in ex.superlatives(frame).collect()}
    assert len(got) == 7
    calm = min(rows, key=lambda r: r["avg_arousal"])
    assert got["Calmest"] == (calm["title"], calm["avg_arousal"])
    happy = max(rows, key=lambda r: r["ratio_joy"])
    assert got["Happiest"] == (happy["title"], happy["ratio_joy"])


def test_superlatives_of_nothing(spark):
    assert ex.superlatives(trajectories(spark, sample(2)).limit(0)).count() == 0


def test_profile(spark):
    row = sample(1)[0]
    row.update({f"avg_{e}": 0.0 for e in EMOTIONS}, avg_valence=0.05, avg_arousal=-0.06)
    row.update(avg_fear=2.0, avg_disgust=2.0, avg_joy=1.0)
    got = ex.emotional_profile(trajectories(spark, [row])).first()
    assert got.dominant == ["fear", "disgust", "joy"]
    assert (got.tone, got.energy) == ("neutral", "calm")
    assert got.ratio_fear == pytest.approx(0.4)


def test_distributions(spark):
    rows = sample()
    frame = trajectories(spark, rows)
    got = {r.emotion: r for r in ev.emotion_distribution(frame).collect()}
    values = [r["ratio_joy"] for r in rows]
    assert got["joy"].mean == pytest.approx(statistics.mean(values))
    assert got["joy"].std == pytest.approx(statistics.stdev(values))
    assert (got["joy"].min, got["joy"].max) == (min(values), max(values))
    means = [r.mean for r in ev.emotion_distribution(frame).collect()]
    assert means == sorted(means, reverse=True)
    assert {r.dimension for r in ev.vad_distribution(frame).collect()} == {"valence", "arousal", "dominance"}
    assert ev.vad_distribution(trajectories(spark, rows[:1])).first().std == 0.0


def test_evaluation(spark):
    rows = sample(12)
    frame = trajectories(spark, rows)
    ids = [str(i) for i in range(6)] + ["nobody"]
    hits = recommend_batch(frame, ids, 4)
    got = hits.collect()
    scores = sorted(r.similarity for r in got)
    stats = ev.similarity_stats(hits).first()
    n = len(scores)
    assert stats.n == n == 24
    assert stats.mean == pytest.approx(statistics.mean(scores))
    assert stats.std == pytest.approx(statistics.pstdev(scores))
    assert (stats.p25, stats.median, stats.p75) == pytest.approx((scores[n // 4], scores[n // 2], scores[3 * n // 4]))
    best = {r.query_id: r.book_id for r in got if r["rank"] == 1}
    pairs = [q for q, b in best.items() if b in best]
    rate = sum(best[best[q]] == q for q in pairs) / len(pairs) if pairs else 0.0
    mutual = ev.reciprocity(hits).first()
    assert mutual.pairs == len(pairs) and mutual.reciprocity_rate == pytest.approx(rate)
    quality = {r.query_id: r for r in ev.query_quality(hits).collect()}
    for query in ids[:-1]:
        mine = sorted((r for r in got if r.query_id == query), key=lambda r: r["rank"])
        assert quality[query].top_rec_id == mine[0].book_id
        assert quality[query].avg_top5_similarity == pytest.approx(statistics.mean(r.similarity for r in mine[:5]))
        assert [h.book_id for h in quality[query].top_5] == [r.book_id for r in mine[:5]]
    report = ev.evaluation_report(frame, ids, top_n=4).first()
    assert (report.books_tested, report.books_skipped) == (6, 1)
    assert report.reciprocity_rate == pytest.approx(rate)
    assert report.median == pytest.approx(stats.median)


def test_evaluation_of_unknown_books(spark):
    report = ev.evaluation_report(trajectories(spark, sample(3)), ["x", "y"]).first()
    assert (report.books_tested, report.books_skipped, report.reciprocity_rate, report.n) == (0, 2, 0.0, 0)
    assert report.median is None
