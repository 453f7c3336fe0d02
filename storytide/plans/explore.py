"""Searches and rankings over a corpus of trajectories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storytide.functions import scores as sc
from storytide.operators.trajectory import shares
from storytide.plans.recommend import low_and_high, rank_order, top_per
from storytide.schema import AVERAGES, AVG_EMOTIONS, EMOTIONS, RATIOS

# Wanted level of each emotion, in the order of VIBE_EMOTIONS.
VIBE_EMOTIONS = ("joy", "anticipation", "surprise", "trust", "sadness", "fear", "anger", "disgust")
VIBES = {
    "Balanced": (0.5, 0.5, 0.3, 0.5, 0.0, 0.0, 0.0, 0.0),
    "Cozy & Uplifting": (0.7, 0.6, 0.2, 0.6, 0.0, 0.0, 0.0, 0.0),
    "Adventurous": (0.5, 0.7, 0.5, 0.4, 0.1, 0.2, 0.0, 0.0),
    "Dark & Tense": (0.1, 0.4, 0.3, 0.2, 0.5, 0.5, 0.2, 0.2),
    "Surprising": (0.4, 0.6, 0.7, 0.3, 0.0, 0.1, 0.0, 0.0),
}

# Label, column, and whether the largest or the smallest value wins.
SUPERLATIVES = (
    ("Happiest", "ratio_joy", "max"),
    ("Saddest", "ratio_sadness", "max"),
    ("Most Exciting", "avg_arousal", "max"),
    ("Calmest", "avg_arousal", "min"),
    ("Most Positive", "avg_valence", "max"),
    ("Most Negative", "avg_valence", "min"),
    ("Most Intense", "avg_dominance", "max"),
)


def vibe_levels(name: str) -> dict[str, float]:
    return dict(zip(VIBE_EMOTIONS, VIBES[name]))


def title_search(
    metadata: DataFrame, query: str | None, limit: int = 20, case_sensitive: bool = False
) -> DataFrame:
    """Books whose title contains ``query``, at most ``limit``, in order of id.

    The case-sensitive form is a LIKE pattern, in which ``%`` and ``_`` are wildcards.
    """
    hits = metadata.select("book_id", "title", "author")
    if not query:
        return hits.limit(0)
    if case_sensitive:
        hits = hits.where(F.col("title").like(f"%{query}%"))
    else:
        hits = hits.where(F.contains(F.lower("title"), F.lower(F.lit(query))))
    return hits.orderBy("book_id").limit(limit)


def top_by_emotion(trajectories: DataFrame, emotion: str, top_n: int = 20) -> DataFrame:
    """Books with the highest mean of one emotion."""
    if emotion.lower() not in EMOTIONS:
        raise ValueError(f"unknown emotion: {emotion}")
    column = f"avg_{emotion.lower()}"
    shown = ("avg_joy", "avg_sadness", "avg_fear", "avg_anger", "avg_valence", "avg_arousal")
    columns = ["book_id", "title", "author", column, *[c for c in shown if c != column]]
    return trajectories.orderBy(*rank_order(column)).limit(top_n).select(*columns)


def superlatives(trajectories: DataFrame) -> DataFrame:
    """The extreme book of each label, in one pass over the corpus."""

    def extreme(label: str, column: str, which: str) -> str:
        sign = "-" if which == "max" else ""
        key = f"struct({sign}{sc.settled(column)} AS v, book_id)"
        entry = f"struct('{label}' AS label, title, author, {column} AS value)"
        return f"min_by({entry}, if({column} IS NULL, null, {key}))"

    entries = ", ".join(extreme(*s) for s in SUPERLATIVES)
    found = trajectories.agg(F.expr(f"array({entries})").alias("found"))
    return found.select(F.explode("found").alias("s")).where("s IS NOT NULL").select("s.*")


def _match(levels: dict[str, float], scale: str) -> str | None:
    """SQL for the closeness to the wanted levels; None when nothing is wanted."""
    squares = []
    for emotion, level in levels.items():
        name = f"avg_{emotion.lower()}"
        if name not in AVG_EMOTIONS or level <= 0:
            continue
        low, high = f"bounds.low_{name}", f"bounds.high_{name}"
        book = sc.scaled(f"coalesce({name}, 0D)", low, high)
        wanted = f"{float(level)!r}D" if scale == "unit" else sc.scaled(f"{float(level)!r}D", low, high)
        squares.append(f"pow(({book}) - ({wanted}), 2)")
    return f"1D / (1D + sqrt({' + '.join(squares)}))" if squares else None


def _with_bounds(trajectories: DataFrame) -> DataFrame:
    bounds = trajectories.agg(F.expr(f"struct({low_and_high(AVG_EMOTIONS)})")).scalar()
    return trajectories.select("book_id", "title", "author", *AVERAGES, bounds.alias("bounds"))


def match_preferences(
    trajectories: DataFrame, levels: dict[str, float], top_n: int = 20, scale: str = "parity"
) -> DataFrame:
    """Books nearest to wanted emotion levels.

    ``scale='parity'`` reads a level as a mean count and scales it by the corpus range,
    ``'unit'`` compares it with the scaled value directly. Unknown emotions are ignored;
    without any positive level there is no match.
    """
    score = _match(levels, scale)
    columns = ("book_id", "title", "author", f"{score or 'double(null)'} AS match_score", *AVERAGES)
    matched = _with_bounds(trajectories).selectExpr(*columns)
    if score is None:
        return matched.limit(0)
    return matched.orderBy(*rank_order("match_score")).limit(top_n)


def vibe_match(trajectories: DataFrame, top_n: int = 20, scale: str = "parity") -> DataFrame:
    """:func:`match_preferences` for every vibe in one job."""
    scored = _with_bounds(trajectories).selectExpr(
        "book_id", "title", "author", *[f"{_match(vibe_levels(v), scale)} AS `{v}`" for v in VIBES]
    )
    long = scored.unpivot(["book_id", "title", "author"], [f"`{v}`" for v in VIBES], "vibe", "match_score")
    return top_per(long, ["vibe"], "match_score", top_n).select(
        "vibe", "rank", "book_id", "title", "author", "match_score"
    )


def emotional_profile(trajectories: DataFrame) -> DataFrame:
    """Tone, energy, leading emotions and the share of each emotion, for all books."""
    return trajectories.select(
        "book_id",
        "title",
        "author",
        sc.tone().alias("tone"),
        sc.energy().alias("energy"),
        sc.dominant_emotions().alias("dominant"),
        *[F.expr(s) for s in shares(AVG_EMOTIONS, RATIOS)],
    )
