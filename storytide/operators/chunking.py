"""Books to positional chunks, and chunks to words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storytide.functions import text as tx
from storytide.functions.stopwords import ENGLISH
from storytide.schema import BOOK_KEY, CHUNK_KEY, VERSION, with_version


def chunk_text(books: DataFrame, num_chunks: int | Column = tx.DEFAULT_CHUNKS) -> DataFrame:
    """Cut each text into ``num_chunks`` equal pieces; the last one takes the rest.

    Pieces carry a hash of the whole text, so that versions of a book stay apart and copies do not.
    A text shorter than ``num_chunks`` gives one piece per character, an empty or null
    one gives none. The count may be a column, so that it can differ from row to row.
    The explode only multiplies row numbers: inside the generated code the text is one
    reference per book and each piece is cut from it, so the text is not copied. Where
    every character is one byte the cut is made in the bytes, without counting characters
    from the start of the text for each piece.
    """
    count = num_chunks if isinstance(num_chunks, Column) else F.lit(num_chunks)
    sized = books.where(F.length("text") > 0).select(
        *BOOK_KEY, "text", F.xxhash64("text").alias(VERSION), count.alias("pieces"), F.length("text").alias("chars")
    )
    numbered = sized.selectExpr(
        *BOOK_KEY,
        VERSION,
        "text",
        "pieces",
        "chars",
        "greatest(1, int(chars div pieces)) AS step",
        "if(octet_length(text) = chars, binary(text), null) AS bytes",
    ).withColumn("chunk_index", F.expr("explode(sequence(0, pieces - 1))"))
    place = "chunk_index * step + 1, if(chunk_index = pieces - 1, chars, step)"
    return numbered.where("chunk_index * step < chars").selectExpr(
        *CHUNK_KEY,
        VERSION,
        f"if(bytes IS NULL, substring(text, {place}), string(substring(bytes, {place}))) AS chunk_text",
    )


def normalise(chunk_texts: DataFrame) -> DataFrame:
    """Add ``plain``: the chunk text as lower-case words separated by spaces."""
    key = with_version(CHUNK_KEY, chunk_texts)
    letters = chunk_texts.select(*key, tx.letters_only(F.col("chunk_text")).alias("letters"))
    return letters.select(*key, tx.expand_contractions(F.col("letters")).alias("plain"))


def tokenize(chunk_texts: DataFrame, stop_words: Sequence[str] = ENGLISH) -> DataFrame:
    """Chunk texts to chunk rows with a word array."""
    return normalise(chunk_texts).select(
        *with_version(CHUNK_KEY, chunk_texts), tx.words("plain", stop_words).alias("words")
    )


def create_chunks(
    books: DataFrame,
    num_chunks: int | Column = tx.DEFAULT_CHUNKS,
    stop_words: Sequence[str] = ENGLISH,
) -> DataFrame:
    """Books with a text column to chunks of words."""
    return tokenize(chunk_text(books, num_chunks), stop_words)
