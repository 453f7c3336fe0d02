"""Which books resemble given ones: a weighted blend of five similarity signals.

The query books (a handful, read by id) become one array value through a scalar
subquery. The corpus is scanned once; each row is compared with that array inside the
task, so there is no join between queries and corpus and nothing is collected to build
the plan. Only narrow scored rows are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storytide.functions import scores as sc
from storytide.functions.genres import genre_tags, jaccard
from storytide.functions.vectors import flat_arc, norm
from storytide.operators import ranks
from storytide.operators.trajectory import completeness_order, dedupe_books
from storytide.schema import AVERAGES, RATIOS, TRAJECTORY, conform

SIGNALS = ("feature", "trajectory", "embedding", "topic", "genre")

# Weight of each signal, in the order of SIGNALS, per use case.
PRESETS = {
    "similar_experience": (0.30, 0.35, 0.15, 0.10, 0.10),
    "similar_themes": (0.20, 0.10, 0.25, 0.35, 0.10),
    "similar_style": (0.20, 0.15, 0.40, 0.15, 0.10),
    "genre_focused": (0.25, 0.15, 0.10, 0.10, 0.40),
    "balanced": (0.30, 0.20, 0.15, 0.15, 0.20),
}
DEFAULT_PRESET = "balanced"


def weight_preset(name: str | None = DEFAULT_PRESET) -> dict[str, float]:
    """Weights of a preset; an unknown name gives the balanced one."""
    return dict(zip(SIGNALS, PRESETS.get(name, PRESETS[DEFAULT_PRESET])))


def normalised(weights: dict[str, float]) -> dict[str, float]:
    total = sum(weights.values())
    return {s: weights.get(s, 0.0) / total if total > 0 else weights.get(s, 0.0) for s in SIGNALS}


def _comparable(trajectories: DataFrame, arc: str) -> DataFrame:
    """Trajectory columns plus flattened arc and vector norms, computed once per book."""
    flat = flat_arc("emotion_trajectory", with_position=arc == "parity")
    vectors = conform(trajectories).selectExpr("*", f"{flat} AS arc")
    return vectors.selectExpr(
        "*",
        f"{norm('arc')} AS arc_norm",
        f"{norm('book_embedding')} AS embedding_norm",
        f"{norm('book_topics')} AS topics_norm",
    )


# What a query book must bring along to be compared.
_QUERY_COLUMNS = (
    "book_id",
    *RATIOS,
    *AVERAGES,
    "arc",
    "arc_norm",
    "book_embedding",
    "embedding_norm",
    "book_topics",
    "topics_norm",
)


_SIGNAL_SQL = {
    "feature": sc.weighted_feature_similarity(),
    "trajectory": sc.arc_similarity(),
    "embedding": sc.embedding_similarity(),
    "topic": sc.topic_similarity(),
}


def _query_books(trajectories: DataFrame, ids: Sequence[str], arc: str) -> Column:
    """The query books as one array value; an id that is given twice counts once."""
    chosen = dedupe_books(trajectories.where(F.col("book_id").isin([str(i) for i in ids])))
    return _comparable(chosen, arc).agg(F.collect_list(F.struct(*_QUERY_COLUMNS))).scalar()


def pair_signals(
    trajectories: DataFrame, ids: Sequence[str], arc: str = "parity", wanted: Sequence[str] = SIGNALS[:4]
) -> DataFrame:
    """Every other book against each query book: one row per pair with its signals.

    ``arc='parity'`` compares arcs with their chunk positions included, ``'shape'``
    compares the emotion shares alone. Queries that are not in the corpus give no rows. All
    queries are compared in one scan.
    """
    corpus = _comparable(trajectories, arc)
    pairs = corpus.withColumn("query", F.explode(_query_books(trajectories, ids, arc))).where("query.book_id <> book_id")
    return pairs.selectExpr(
        "query.book_id AS query_id",
        *TRAJECTORY.names,
        *[f"{_SIGNAL_SQL[s]} AS {s}_similarity" for s in wanted],
    )


def compared_books(
    trajectories: DataFrame, ids: Sequence[str], arc: str = "parity", wanted: Sequence[str] = SIGNALS[:4]
) -> DataFrame:
    """The corpus with ``pairs``: for each other query book its id and the signals, in one array.

    A row stays one row however many queries there are.
    """
    rows = _comparable(trajectories, arc).withColumn("queries", _query_books(trajectories, ids, arc))
    fields = ", ".join(["query.book_id AS query_id", *(f"{_SIGNAL_SQL[s]} AS {s}_similarity" for s in wanted)])
    others = "filter(queries, query -> query.book_id <> book_id)"
    return rows.selectExpr(
        *TRAJECTORY.names, f"transform({others}, query -> struct({fields})) AS pairs"
    )


def metadata_tags(metadata: DataFrame) -> DataFrame:
    """``book_id, tags``: one row per book, however often the catalogue lists it."""
    listed = metadata.groupBy("book_id").agg(F.min(F.struct("bookshelves", "subjects")).alias("m"))
    return listed.select("book_id", _once(genre_tags("m.bookshelves", "m.subjects")).alias("tags"))


def _once(value: Column) -> Column:
    """``value``, computed once a row: a generator is not copied into the conditions and lambdas that use its column."""
    return F.explode(F.array(value))


def _tagged_queries(metadata: DataFrame, ids: Sequence[str]) -> Column:
    """The query books that have tags, as one array value."""
    tagged = metadata_tags(metadata.where(F.col("book_id").isin([str(i) for i in ids])))
    return tagged.where(F.size("tags") > 0).agg(F.collect_list(F.struct("book_id", "tags"))).scalar()


def genre_pairs(metadata: DataFrame, ids: Sequence[str]) -> DataFrame:
    """``query_id, book_id, genre_similarity`` for all other books of the catalogue.

    Queries without tags give no rows.
    """
    pairs = metadata_tags(metadata).withColumn("query", F.explode(_tagged_queries(metadata, ids)))
    return pairs.where("query.book_id <> book_id").select(
        F.col("query.book_id").alias("query_id"),
        "book_id",
        jaccard("tags", "query.tags").alias("genre_similarity"),
    )


def genre_scores(metadata: DataFrame, ids: Sequence[str]) -> DataFrame:
    """``book_id, genres``: for books that share a tag with any query, the similarity by query id.

    The queries' tags are an index from tag to queries. A book is looked up there by its tags, so
    only queries that it shares one with are scored, and books without any are no rows.
    """
    queries = _tagged_queries(metadata, ids)
    rows = metadata_tags(metadata).select("book_id", "tags", queries.alias("queries"))
    entries = "flatten(transform(queries, q -> transform(q.tags, t -> struct(t AS tag, q AS query))))"
    met = f"array_distinct(transform(filter({entries}, e -> array_contains(tags, e.tag) AND e.query.book_id <> book_id), e -> e.query))"
    found = rows.where("arrays_overlap(tags, flatten(queries.tags))").select("book_id", "tags", _once(F.expr(met)).alias("met"))
    union = "size(array_union(tags, q.tags))"
    scores = f"transform(met, q -> struct(q.book_id, size(array_intersect(tags, q.tags)) / {union}))"
    return found.where("size(met) > 0").selectExpr("book_id", f"map_from_entries({scores}) AS genres")


def blended(weights: dict[str, float], renormalize: bool = False) -> str:
    """SQL for the weighted sum of the signals.

    A missing signal counts as zero. With ``renormalize`` its weight goes to the signals
    that the pair does have.
    """
    # Only signals with a weight are named: the others are then never computed.
    share = {s: w for s, w in normalised(weights).items() if w > 0}
    if not share:
        return "0D"
    total = " + ".join(f"{w!r}D * coalesce({s}_similarity, 0D)" for s, w in share.items())
    if not renormalize:
        return total
    presence = {
        "feature": "true",
        "trajectory": "emotion_trajectory IS NOT NULL",
        "embedding": "book_embedding IS NOT NULL",
        "topic": "book_topics IS NOT NULL",
        "genre": "genre_similarity IS NOT NULL",
    }
    held = " + ".join(f"if({presence[s]}, {w!r}D, 0D)" for s, w in share.items())
    return f"CASE WHEN {held} > 0 THEN ({total}) / ({held}) ELSE 0D END"


def candidates(
    trajectories: DataFrame,
    ids: Sequence[str],
    metadata: DataFrame | None = None,
    arc: str = "parity",
    unique: bool = False,
    carry: Sequence[str] = (),
    wanted: Sequence[str] = SIGNALS[:4],
) -> DataFrame:
    """All pairs with the wanted signals; ``genre_similarity`` is null without metadata.

    Pass ``unique=True`` for a corpus known to hold each book once: it saves the shuffle
    that removes repeated books.
    """
    books = compared_books(trajectories, ids, arc, wanted)
    columns = ["book_id", "title", "author", *AVERAGES, *carry, "pairs"]
    if not unique:
        books = one_row_per_book(books.select(*columns, completeness_order().alias("completeness")))
    books = books.select(columns)
    similarity = F.lit(None).cast("double")
    if metadata is not None:
        books = books.join(genre_scores(metadata, ids), "book_id", "left")
        similarity = F.try_element_at("genres", F.col("pair.query_id"))
    long = books.withColumn("pair", F.explode("pairs"))
    return long.select("pair.query_id", *columns[:-1], *[f"pair.{s}_similarity" for s in wanted], similarity.alias("genre_similarity"))


def one_row_per_book(books: DataFrame) -> DataFrame:
    """Of repeated books the most complete row, as :func:`dedupe_books` does, by ``completeness``.

    Rows are compared before there are pairs of them, so as many are shuffled as there are books.
    """
    window = Window.partitionBy("book_id").orderBy("completeness")
    return books.withColumn("place", F.row_number().over(window)).where("place = 1").drop("place", "completeness")


def rank_order(score: str) -> list[Column]:
    return [F.expr(sc.settled(score)).desc(), F.col("book_id").asc()]


def top_per(rows: DataFrame, keys: Sequence[str], score: str, top_n: int) -> DataFrame:
    """The best ``top_n`` rows of each key with their ``rank``."""
    return ranks.top_per(rows, keys, [F.expr(sc.settled(score)), F.col("book_id")], top_n)


def _weighted(weights: dict[str, float]) -> list[str]:
    """The signals with a weight: the others are never computed, so their columns are not read."""
    return [s for s in SIGNALS[:4] if weights.get(s, 0.0) > 0]


def _needed(with_arc: bool, renormalize: bool) -> tuple[str, ...]:
    carried = ("emotion_trajectory",) if with_arc or renormalize else ()
    return carried + (("book_embedding", "book_topics") if renormalize else ())


def _result(scored: DataFrame, leading: Sequence[str], with_arc: bool) -> DataFrame:
    arc = ("emotion_trajectory",) if with_arc else ()
    return scored.select(*leading, "book_id", "title", "author", "similarity", *AVERAGES, *arc)


def recommend(
    trajectories: DataFrame,
    book_id: str,
    top_n: int = 10,
    *,
    weights: dict[str, float] | None = None,
    preset: str | None = None,
    metadata: DataFrame | None = None,
    arc: str = "parity",
    renormalize: bool = False,
    unique: bool = False,
    with_arc: bool = True,
) -> DataFrame:
    """The ``top_n`` books most similar to one book, best first."""
    chosen = weight_preset(preset) if preset or weights is None else weights
    genres = metadata if chosen.get("genre", 0.0) > 0 else None
    carry = _needed(with_arc, renormalize)
    pairs = candidates(trajectories, [book_id], genres, arc, unique, carry, _weighted(chosen))
    scored = pairs.selectExpr("*", f"{blended(chosen, renormalize)} AS similarity")
    return _result(scored.orderBy(*rank_order("similarity")).limit(top_n), (), with_arc)


def recommend_batch(
    trajectories: DataFrame,
    ids: Sequence[str],
    top_n: int = 10,
    *,
    weights: dict[str, float] | None = None,
    preset: str | None = None,
    metadata: DataFrame | None = None,
    arc: str = "parity",
    renormalize: bool = False,
    unique: bool = False,
    with_arc: bool = False,
) -> DataFrame:
    """:func:`recommend` for many books in one job, with ``query_id`` and ``rank``."""
    chosen = weight_preset(preset) if preset or weights is None else weights
    genres = metadata if chosen.get("genre", 0.0) > 0 else None
    carry = _needed(with_arc, renormalize)
    pairs = candidates(trajectories, ids, genres, arc, unique, carry, _weighted(chosen))
    scored = pairs.selectExpr("*", f"{blended(chosen, renormalize)} AS similarity")
    return _result(top_per(scored, ["query_id"], "similarity", top_n), ("query_id", "rank"), with_arc)


def preset_comparison(
    trajectories: DataFrame,
    ids: Sequence[str],
    metadata: DataFrame | None = None,
    top_n: int = 5,
    arc: str = "parity",
    unique: bool = False,
) -> DataFrame:
    """Top books under every weight preset; the signals are computed once."""
    pairs = candidates(trajectories, ids, metadata, arc, unique)
    scored = pairs.selectExpr(
        "query_id", "book_id", "title", *[f"{blended(weight_preset(p))} AS {p}" for p in PRESETS]
    )
    long = scored.unpivot(["query_id", "book_id", "title"], list(PRESETS), "preset", "similarity")
    return top_per(long, ["query_id", "preset"], "similarity", top_n).select(
        "query_id", "preset", "rank", "book_id", "title", "similarity"
    )


def low_and_high(columns: Sequence[str]) -> str:
    return ", ".join(f"min({c}) AS low_{c}, max({c}) AS high_{c}" for c in columns)


# ---- single signals -------------------------------------------------------------


def _single(trajectories: DataFrame, book_id: str, signal: str, arc: str, wide: bool) -> DataFrame:
    pairs = pair_signals(trajectories, [book_id], arc, (signal,))
    extra = ("title", "author", *AVERAGES, "emotion_trajectory") if wide else ()
    return pairs.select("book_id", *extra[:2], f"{signal}_similarity", *extra[2:])


def feature_similarity(trajectories: DataFrame, book_id: str) -> DataFrame:
    return _single(trajectories, book_id, "feature", "parity", wide=True)


def trajectory_similarity(trajectories: DataFrame, book_id: str, arc: str = "parity") -> DataFrame:
    return _single(trajectories, book_id, "trajectory", arc, wide=False)


def embedding_similarity(trajectories: DataFrame, book_id: str) -> DataFrame:
    return _single(trajectories, book_id, "embedding", "parity", wide=False)


def topic_similarity(trajectories: DataFrame, book_id: str) -> DataFrame:
    return _single(trajectories, book_id, "topic", "parity", wide=False)


def genre_similarity(metadata: DataFrame, book_id: str) -> DataFrame:
    return genre_pairs(metadata, [book_id]).select("book_id", "genre_similarity")


def feature_similarity_minmax(trajectories: DataFrame, book_id: str) -> DataFrame:
    """Closeness of the eleven averages after min-max scaling over all other books."""
    books = conform(trajectories)
    others = books.where(F.col("book_id") != str(book_id))
    bounds = others.agg(F.expr(f"struct({low_and_high(AVERAGES)})")).scalar()
    liked = dedupe_books(books.where(F.col("book_id") == str(book_id)))
    query = liked.agg(F.first(F.struct("book_id", *AVERAGES))).scalar()
    compared = others.select("*", bounds.alias("bounds"), query.alias("query")).where("query IS NOT NULL")
    return compared.selectExpr(
        *("book_id", "title", "author"),
        f"{sc.minmax_feature_similarity()} AS feature_similarity",
        *AVERAGES,
        "emotion_trajectory",
    )
