"""Scoring of chunks against a word-emotion and a valence/arousal/dominance lexicon.

Words meet the lexicon in a join. Every chunk also emits one marker token that the
lexicon answers with zeros: an inner join then keeps chunks without any hit, words
that are not in the lexicon never reach the aggregate, and the partial aggregate
shrinks a chunk to one row before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storytide.operators.chunking import normalise
from storytide.operators.joins import likely_in
from storytide.schema import CHUNK_KEY, DIMENSIONS, EMOTIONS, with_version
from storytide.workspace import MAX_BROADCAST_ROWS, within

# No word can equal it: normalised text has letters, digits and spaces only.
MARKER = "#"
# Spread of each word in the shuffled fallback for lexicons too large to broadcast.
SALTS = 32

_VALUES = "struct<valence:double,arousal:double,dominance:double>"


def word_scores(emotions: DataFrame, vad: DataFrame, only: str | None = None) -> DataFrame:
    """Both lexicons as one row per word: eight 0/1 flags, three values, and the marker.

    A word listed twice for an emotion counts once; of a repeated term the smallest
    values are kept.

    ``only`` (an SQL condition on ``word``) restricts the words, so that it is checked
    once per lexicon entry and not once per token of the corpus.
    """
    listed = ", ".join(repr(e) for e in EMOTIONS)
    known = emotions.where(f"value = 1 AND emotion IN ({listed})").selectExpr(
        "word", "emotion", f"cast(null AS {_VALUES}) AS v"
    )
    placed = vad.selectExpr("term AS word", "string(null) AS emotion", f"struct({', '.join(DIMENSIONS)}) AS v")
    rows = known.unionByName(placed).where(f"word <> '{MARKER}'")
    flags = [F.expr(f"max(int(coalesce(emotion = '{e}', false))) AS {e}") for e in EMOTIONS]
    table = (
        rows.where(only or "true")
        .groupBy("word")
        .agg(*flags, F.expr("min(v) AS v"))
        .select("word", *EMOTIONS, "v.*", F.lit(0).alias("marks"))
    )
    marker = emotions.sparkSession.range(1).selectExpr(
        f"'{MARKER}' AS word",
        *[f"0 AS {e}" for e in EMOTIONS],
        *[f"double(null) AS {d}" for d in DIMENSIONS],
        "1 AS marks",
    )
    return table.unionByName(marker)


def _aggregate(hits: DataFrame) -> DataFrame:
    """Hits (each with the number of ``times`` it occurs) to one row per chunk.

    A chunk is identified by its key, the hash of its book's text included. If the same text was
    ingested more than once its copies fall together here; counts are then per copy, so a
    duplicate never inflates a book and no group grows with the number of copies. Different texts
    under one id stay apart.
    """

    def per_copy(total: str) -> str:
        return f"int(round({total} / sum(marks)))"

    def mean(name: str) -> str:
        return f"coalesce(sum({name} * times) / sum(if({name} IS NULL, null, times)), 0D)"

    measures = [f"{per_copy(f'sum({e} * times)')} AS {e}" for e in EMOTIONS]
    measures += [f"{mean(d)} AS avg_{d}" for d in DIMENSIONS]
    measures.append(f"{per_copy('sum(if(valence IS NULL, 0, times))')} AS vad_word_count")
    return hits.groupBy(*with_version(CHUNK_KEY, hits)).agg(*[F.expr(m) for m in measures])


def _score(tokens: DataFrame, lexicon: DataFrame, small: bool | None) -> DataFrame:
    if within(lexicon, MAX_BROADCAST_ROWS) if small is None else small:
        hits = tokens.join(F.broadcast(lexicon.withColumnRenamed("word", "token")), "token")
        return _aggregate(hits.withColumn("times", F.lit(1)))

    # Too large to send everywhere, but its words fit a bitmap, which drops the tokens without a
    # hit where they are read. The others are counted in each chunk and joined on word and
    # salt, so that a frequent word is spread over SALTS tasks. Marker rows carry a key of
    # their own, unmatched by design, so they do not gather in one task.
    tokens = likely_in(tokens, lexicon.select(F.col("word").alias("token")), "token")
    key = with_version(CHUNK_KEY, tokens)
    chunk = f"xxhash64({', '.join(key)})"
    counted = tokens.groupBy(*key, "token").agg(F.count(F.lit(1)).alias("times"))
    keyed = counted.selectExpr(
        *key,
        "times",
        f"if(token = '{MARKER}', times, 0) AS marks",
        f"if(token = '{MARKER}', concat('{MARKER}', {chunk}), token) AS word",
        f"pmod({chunk}, {SALTS}) AS salt",
    )
    salted = (
        lexicon.where(f"word <> '{MARKER}'")
        .drop("marks")
        .selectExpr("*", f"explode(sequence(0, {SALTS - 1})) AS salt", "true AS found")
        .withColumn("salt", F.col("salt").cast("bigint"))
    )
    hits = keyed.join(salted, ["word", "salt"], "left").where("marks > 0 OR found")
    return _aggregate(hits.na.fill(0, list(EMOTIONS)))


def score_chunks(chunks: DataFrame, lexicon: DataFrame, small: bool | None = None) -> DataFrame:
    """Emotion counts and mean valence/arousal/dominance of each chunk of words.

    ``lexicon`` is a table of :func:`word_scores`. Chunks without a hit, or without words,
    are kept with zeros. ``small`` tells whether the lexicon may be broadcast, if that has
    been counted already.
    """
    given = f"coalesce(array_remove(words, '{MARKER}'), array())"
    marked = f"explode(concat(array('{MARKER}'), {given})) AS token"
    return _score(chunks.selectExpr(*with_version(CHUNK_KEY, chunks), marked), lexicon, small)


def score_text(chunk_texts: DataFrame, lexicon: DataFrame, small: bool | None = None) -> DataFrame:
    """``score_chunks(tokenize(...))`` without building the word arrays.

    ``lexicon`` must be without stop words and short words (``only=is_word("word")``),
    which gives the same counts as taking them out of each text.
    """
    marked = f"explode(split(concat('{MARKER} ', plain), ' ')) AS token"
    return _score(normalise(chunk_texts).selectExpr(*with_version(CHUNK_KEY, chunk_texts), marked), lexicon, small)


def score_emotions(chunk_scores: DataFrame) -> DataFrame:
    return chunk_scores.select(*with_version(CHUNK_KEY, chunk_scores), *EMOTIONS)


def score_vad(chunk_scores: DataFrame) -> DataFrame:
    return chunk_scores.select(*with_version(CHUNK_KEY, chunk_scores), *[f"avg_{d}" for d in DIMENSIONS], "vad_word_count")
