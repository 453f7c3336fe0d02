"""Similarity signals between a candidate book and a query book, and value labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storytide.functions.vectors import cosine, norm
from storytide.schema import AVERAGES, EMOTIONS, EVEN_SHARE, NEUTRAL_DIMENSION

# Sums over a shuffle differ in their last bits from run to run, and copies of a book tie
# exactly: scores are compared at this precision, ties are broken by id. The offset
# keeps values that lie exactly on a rounding boundary from falling on either side.
RANK_DIGITS = 9
RANK_OFFSET = 1e-12

# How strongly each feature separates books.
FEATURE_WEIGHTS = {
    "ratio_anger": 1.5,
    "ratio_anticipation": 2.0,
    "ratio_disgust": 1.5,
    "ratio_fear": 3.0,
    "ratio_joy": 3.0,
    "ratio_sadness": 2.0,
    "ratio_surprise": 1.5,
    "ratio_trust": 0.5,
    "avg_valence": 4.0,
    "avg_arousal": 4.0,
    "avg_dominance": 4.0,
}

# Thresholds of the labels shown for a tone, a similarity or a match.
TONE_MARGIN = 0.05
SIMILARITY_BUCKETS = ((0.9, "very similar"), (0.8, "similar"), (0.7, "related"))
SIMILARITY_REST = "loosely related"
MATCH_BUCKETS = ((0.8, "excellent"), (0.6, "good"), (0.4, "fair"))
MATCH_REST = "partial"

# The order in which equally strong emotions are listed.
DISPLAY_ORDER = ("joy", "trust", "anticipation", "surprise", "sadness", "fear", "anger", "disgust")


def _closeness(gaps: list[str]) -> str:
    squares = " + ".join(f"({gap}) * ({gap})" for gap in gaps)
    return f"1D / (1D + sqrt({squares}))"


def scaled(value: str, low: str, high: str) -> str:
    """Min-max scaling; the middle where the range is empty."""
    return f"CASE WHEN {high} > {low} THEN ({value} - {low}) / ({high} - {low}) ELSE 0.5D END"


# Each signal takes two prefixes: ``book`` and ``query`` name the two sides, such as ""
# for the columns of the row itself and "query." for the fields of a struct.


def weighted_feature_similarity(book: str = "", query: str = "query.") -> str:
    """Closeness of emotional profiles, weighted by how telling each feature is."""

    def value(side: str, name: str) -> str:
        neutral = EVEN_SHARE if name.startswith("ratio_") else NEUTRAL_DIMENSION
        return f"coalesce({side}{name}, {neutral}D)"

    return _closeness([f"({value(book, f)} - {value(query, f)}) * {w}D" for f, w in FEATURE_WEIGHTS.items()])


def minmax_feature_similarity(book: str = "", query: str = "query.", bounds: str = "bounds.") -> str:
    """Unweighted closeness of the eleven averages after min-max scaling."""

    def value(side: str, name: str) -> str:
        return scaled(f"coalesce({side}{name}, 0D)", f"{bounds}low_{name}", f"{bounds}high_{name}")

    return _closeness([f"{value(book, f)} - {value(query, f)}" for f in AVERAGES])


def arc_similarity(book: str = "", query: str = "query.") -> str:
    """Cosine of the flattened arcs, the shorter one continued with zeros."""
    return cosine(f"{book}arc", f"{query}arc", f"{book}arc_norm", f"{query}arc_norm")


def embedding_similarity(book: str = "", query: str = "query.") -> str:
    """Cosine moved to 0..1; 0 unless both vectors exist, match in length and are non-zero."""
    left, right = f"{book}book_embedding", f"{query}book_embedding"
    norms = (f"{book}embedding_norm", f"{query}embedding_norm")
    usable = f"size({left}) = size({right}) AND {norms[0]} * {norms[1]} > 0"
    return f"CASE WHEN {usable} THEN ({cosine(left, right, *norms)} + 1D) / 2D ELSE 0D END"


def topic_similarity(book: str = "", query: str = "query.") -> str:
    """Cosine over the positions both mixtures have."""
    left, right = f"{book}book_topics", f"{query}book_topics"
    shared = f"least(size({left}), size({right}))"
    cut = (f"slice({left}, 1, {shared})", f"slice({right}, 1, {shared})")
    return f"""CASE WHEN {left} IS NULL OR {right} IS NULL THEN 0D
      WHEN size({left}) = size({right})
        THEN {cosine(left, right, f"{book}topics_norm", f"{query}topics_norm")}
      ELSE {cosine(*cut, norm(cut[0]), norm(cut[1]))} END"""


def settled(value: str) -> str:
    """A value as it is compared and ranked: without the bits that vary from run to run."""
    return f"round({value} + {RANK_OFFSET}D, {RANK_DIGITS})"


def _side_of_zero(value: str, above: str, below: str, between: str) -> Column:
    value = settled(value)
    return F.expr(
        f"CASE WHEN {value} > {TONE_MARGIN}D THEN '{above}' WHEN {value} < -{TONE_MARGIN}D THEN '{below}' "
        f"ELSE '{between}' END"
    )


def tone(valence: str = "avg_valence") -> Column:
    return _side_of_zero(valence, "positive", "negative", "neutral")


def energy(arousal: str = "avg_arousal") -> Column:
    return _side_of_zero(arousal, "high-energy", "calm", "moderate")


def _bucket(score: str, steps: tuple[tuple[float, str], ...], rest: str) -> Column:
    arms = " ".join(f"WHEN {settled(score)} > {floor}D THEN '{name}'" for floor, name in steps)
    return F.expr(f"CASE {arms} ELSE '{rest}' END")


def similarity_bucket(score: str = "similarity") -> Column:
    return _bucket(score, SIMILARITY_BUCKETS, SIMILARITY_REST)


def match_bucket(score: str = "match_score") -> Column:
    return _bucket(score, MATCH_BUCKETS, MATCH_REST)


def dominant_emotions(top: int = 3, among: tuple[str, ...] = EMOTIONS) -> Column:
    """Names of the strongest positive average emotions, strongest first."""
    ranked = ", ".join(
        f"struct(-avg_{e} AS weakness, {i} AS place, '{e}' AS name)"
        for i, e in enumerate(DISPLAY_ORDER)
        if e in among
    )
    leading = f"slice(array_sort(array({ranked})), 1, {top})"
    return F.expr(f"transform(filter({leading}, r -> r.weakness < 0), r -> r.name)")
