"""Text normalisation as native string expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from storytide.functions.stopwords import ENGLISH

# start/end markers of a distributed e-text, English contractions with
# their replacements in the order they are applied, and the shortest word that counts.
MARKERS = (r"(?s)\*\*\* START.*?\*\*\*", r"(?s)\*\*\* END.*?\*\*\*")
CONTRACTIONS = (
    (r"'s\b", ""),
    (r"n't\b", " not"),
    (r"'re\b", " are"),
    (r"'ve\b", " have"),
    (r"'ll\b", " will"),
    (r"'d\b", " would"),
    (r"'", ""),
)
MIN_WORD_LENGTH = 3

# Chunks of a corpus book, and of a shorter ad-hoc text.
DEFAULT_CHUNKS = 20
SHORT_TEXT_CHARS = 10_000
SHORT_TEXT_MIN_CHUNKS = 5
SHORT_TEXT_MAX_CHUNKS = 10
CHARS_PER_SHORT_CHUNK = 1_000


def decode_utf8(content: Column) -> Column:
    """Bytes to text; sequences that are not UTF-8 are dropped.

    Repairing puts U+FFFD in their place. Where the text has that character of its own, it is
    kept: three noncharacters in a row stand for it meanwhile.
    """
    raw = content.cast("string")
    own, aside = F.lit("\ufffd"), F.lit("\ufdd0\ufdd1\ufdd0")
    repaired = F.replace(F.make_valid_utf8(F.replace(raw, own, aside)), own, F.lit(""))
    return F.when(F.is_valid_utf8(raw), raw).otherwise(F.replace(repaired, aside, own))


def fold_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def strip_markers(text: Column) -> Column:
    """Remove the start and end marker lines, leaving what surrounds them."""
    for pattern in MARKERS:
        text = F.regexp_replace(text, pattern, "")
    return text


def adaptive_chunks(text: Column) -> Column:
    """Chunk count for an ad-hoc text: fewer chunks when it is short."""
    by_length = F.floor(F.length(text) / CHARS_PER_SHORT_CHUNK).cast("int")
    few = F.greatest(
        F.lit(SHORT_TEXT_MIN_CHUNKS), F.least(F.lit(SHORT_TEXT_MAX_CHUNKS), by_length)
    )
    return F.when(F.length(text) < SHORT_TEXT_CHARS, few).otherwise(F.lit(DEFAULT_CHUNKS))


# Everything but a-z, 0-9 and the apostrophe, as ranges: the same set written as a
# negated class takes Java's matcher four to five times as long.
SEPARATORS = r"[\x00-&(-/:-`{-\x{10ffff}]+"


def letters_only(text: Column) -> Column:
    """Lower-case; every run of other characters becomes one space."""
    return F.regexp_replace(F.lower(text), SEPARATORS, " ")


def expand_contractions(letters: Column) -> Column:
    """Resolve apostrophes. Text without any skips the seven passes."""
    expanded = letters
    for pattern, replacement in CONTRACTIONS:
        expanded = F.regexp_replace(expanded, pattern, replacement)
    return F.when(F.contains(letters, F.lit("'")), expanded).otherwise(letters)


def is_word(token: str, stop_words: Sequence[str] = ENGLISH) -> str:
    """SQL condition: ``token`` is long enough and no stop word.

    Normalised tokens consist of letters and digits, so a stop word with any other
    character (an apostrophe) cannot occur and is left out of the comparison.
    """
    comparable = sorted({w for w in stop_words if re.fullmatch("[a-z0-9]+", w)})
    long_enough = f"length({token}) >= {MIN_WORD_LENGTH}"
    if not comparable:
        return long_enough
    return f"{long_enough} AND {token} NOT IN ({', '.join(repr(w) for w in comparable)})"


def words(plain: str, stop_words: Sequence[str] = ENGLISH) -> Column:
    """Word array of a column of normalised text, without stop words and short words."""
    return F.expr(f"filter(split({plain}, ' '), token -> {is_word('token', stop_words)})")
