"""Language identification by compression.

Training keeps, for each language, a raw-content dictionary: passages of labelled texts, of
which only the letters count, in lower case. Passages that the dictionaries of the other half
of the passages give to another language are left out, as their label is likely wrong. A
text belongs to the language whose dictionary compresses it best: its blocks are compressed
with every dictionary and the sizes added up; where that leaves little between two languages,
again at a level that searches harder. The margin is the share of the second smallest size by
which the smallest is smaller; the score grows with it, and with a narrow margin the
prediction is marked ``rejected`` (it is still given).

Bounds: at most ``SLOTS`` passages of ``PASSAGE`` characters for each language are kept
for a dictionary of ``DICTIONARY_BYTES``. A passage is chosen by the hash of its text, so
copies count once however many there are. Only these dictionaries pass through the driver.

A null text or one without a letter is ``und`` with score 0 and rejected; so is every text
when no labelled text exists. Equal sizes go to the language with more labelled texts, then to
the first by name. Texts are read whole, in blocks, whatever their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storytide.llm.runtime import ship

SLOTS = 512
PASSAGE = 256
DICTIONARY_BYTES = 112 << 10
BLOCK_BYTES = 8 << 10
LEVEL = 3
HARD_LEVEL = 19
HARD_MARGIN = 0.06  # below it the harder level decides
MIN_MARGIN = 0.02

_NO_LETTERS = re.compile(r"[\W\d_]+")

UNKNOWN = "und"
RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("margin", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)


def learn_dictionaries(labelled: DataFrame) -> dict[str, bytes]:
    """A dictionary for each language of ``labelled`` (``lang``, ``text``), by name.

    Each text offers one passage, from a place that its hash tells. Of the passages whose
    hash falls in the same slot the one with the smallest hash is kept, so the aggregation
    holds ``SLOTS`` passages for a language in each task, before and after the shuffle.
    """
    hashed = labelled.where("lang is not null and length(text) > 0").select("lang", "text", F.xxhash64("text").alias("h"))
    start = F.pmod(F.col("h"), F.greatest(F.length("text") - PASSAGE, F.lit(1))) + 1
    passage = F.col("text").substr(start.cast("int"), F.lit(PASSAGE))
    offered = hashed.select("lang", F.pmod(F.shiftright("h", 20), F.lit(SLOTS)).alias("slot"), "h", passage.alias("passage"))
    kept = offered.groupBy("lang", "slot").agg(F.min_by("passage", "h").alias("passage"), F.count("*").alias("n"))
    rows = kept.orderBy("lang", "slot").collect()
    counts: dict[str, int] = {}
    for row in rows:
        counts[row.lang] = counts.get(row.lang, 0) + row.n
    names = sorted(counts, key=lambda lang: (-counts[lang], lang))

    def dictionaries(chosen: list) -> dict[str, bytes]:
        texts = {lang: " ".join(letters(r.passage) for r in chosen if r.lang == lang) for lang in names}
        return {lang: text.encode()[-DICTIONARY_BYTES:] for lang, text in texts.items() if text}

    halves = [Compressors(dictionaries([r for r in rows if r.slot % 2 == half])) for half in (0, 1)]
    trusted = [r for r in rows if (other := halves[1 - r.slot % 2]).names and other.judge(r.passage)[0] == r.lang]
    lost = set(names) - {r.lang for r in trusted}
    return dictionaries(trusted + [r for r in rows if r.lang in lost])


def letters(text: str) -> str:
    """The words of a text in lower case, one space between them."""
    return _NO_LETTERS.sub(" ", text.lower())


def _letters(texts: pd.Series) -> pd.Series:
    return texts.str.contains(r"[^\W\d_]", regex=True).fillna(False).astype(bool)


class Compressors:
    """The digested dictionaries of all languages, in order of preference."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = list(dictionaries)
        self.levels = [[self._one(content, level) for content in dictionaries.values()] for level in (LEVEL, HARD_LEVEL)]
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    @staticmethod
    def _one(content: bytes, level: int) -> zstandard.ZstdCompressor:
        kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        kept.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=kept, write_content_size=False, write_dict_id=False)

    def _margin(self, blocks: list[bytes], compressors: list) -> tuple[int, float]:
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in compressors]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = [s for i, s in enumerate(sizes) if i != best] or [sum(len(self.plain.compress(b)) for b in blocks)]
        return best, max(0.0, (min(others) - sizes[best]) / min(others))

    def judge(self, text: str) -> tuple[str, float, float, bool]:
        raw = letters(text).encode("utf-8", "surrogatepass")
        blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
        best, margin = self._margin(blocks, self.levels[0])
        if margin < HARD_MARGIN:
            best, margin = self._margin(blocks, self.levels[1])
        return self.names[best], min(1.0, 0.5 + 4 * margin), margin, margin < MIN_MARGIN


def predict(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """``docs`` with ``lang_pred, score, margin, rejected``; reads nothing but ``text``.

    Columns of ``docs`` with one of these names are replaced, all others are kept.
    """
    spark = docs.sparkSession
    ship(spark)
    known = spark.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compressors = Compressors(known.value)
        none = (UNKNOWN, 0.0, 0.0, True)
        for texts in batches:
            readable = _letters(texts) if compressors.names else pd.Series(False, texts.index)
            rows = [compressors.judge(text) if ok else none for text, ok in zip(texts, readable)]
            yield pd.DataFrame(rows, columns=RESULT.names)

    judge = F.pandas_udf(run, RESULT)
    rest = [c for c in docs.columns if c not in RESULT.names]
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), judge("text").alias("p")).select("row.*", "p.*")
