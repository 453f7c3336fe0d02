"""Fixed schemas shared by every step, and the constants that name their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The eight basic emotions, in the order used by every vector and arc.
EMOTIONS = ("anger", "anticipation", "disgust", "fear", "joy", "sadness", "surprise", "trust")
DIMENSIONS = ("valence", "arousal", "dominance")

# The share of each emotion where nothing was found, and the neutral
# values assumed for a missing ratio or a missing valence/arousal/dominance mean.
EVEN_SHARE = 0.125
NEUTRAL_DIMENSION = 0.5

AVG_EMOTIONS = tuple(f"avg_{e}" for e in EMOTIONS)
AVG_DIMENSIONS = tuple(f"avg_{d}" for d in DIMENSIONS)
AVERAGES = AVG_EMOTIONS + AVG_DIMENSIONS
RATIOS = tuple(f"ratio_{e}" for e in EMOTIONS)
BOOK_KEY = ("book_id", "title", "author")
CHUNK_KEY = (*BOOK_KEY, "chunk_index")
# Hash of the text that a chunk was cut from: copies of a book have one, other versions another.
VERSION = "text_hash"


def with_version(key: tuple[str, ...], rows: DataFrame) -> tuple[str, ...]:
    """``key``, and the version of the text where ``rows`` tell it."""
    return (*key, VERSION) if VERSION in rows.columns else key


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_STRING, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_DOUBLES = T.ArrayType(_DOUBLE)

BOOKS = _struct(book_id=_STRING, title=_STRING, author=_STRING, text=_STRING)
METADATA = _struct(
    book_id=_STRING,
    title=_STRING,
    author=_STRING,
    language=_STRING,
    bookshelves=_STRING,
    subjects=_STRING,
)
CHUNKS = _struct(
    book_id=_STRING,
    title=_STRING,
    author=_STRING,
    chunk_index=_INT,
    words=T.ArrayType(_STRING),
)
EMOTION_LEXICON = _struct(word=_STRING, emotion=_STRING, value=_INT)
VAD_LEXICON = _struct(term=_STRING, valence=_DOUBLE, arousal=_DOUBLE, dominance=_DOUBLE)
CHUNK_SCORES = _struct(
    book_id=_STRING,
    title=_STRING,
    author=_STRING,
    chunk_index=_INT,
    **{e: _INT for e in EMOTIONS},
    **{c: _DOUBLE for c in AVG_DIMENSIONS},
    vad_word_count=_INT,
)
TRAJECTORY = _struct(
    book_id=_STRING,
    title=_STRING,
    author=_STRING,
    **{c: _DOUBLE for c in AVERAGES},
    num_chunks=_LONG,
    emotion_trajectory=T.ArrayType(_DOUBLES),
    **{c: _DOUBLE for c in RATIOS},
    book_embedding=_DOUBLES,
    book_topics=_DOUBLES,
)


def conform(df: DataFrame, schema: T.StructType = TRAJECTORY) -> DataFrame:
    """Give ``df`` exactly the columns of ``schema``; absent ones become typed nulls."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"cast({f.name if f.name in present else 'null'} as {f.dataType.simpleString()}) as {f.name}"
            for f in schema
        ]
    )
