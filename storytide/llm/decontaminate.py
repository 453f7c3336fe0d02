"""Benchmark decontamination: find test passages in training texts and take them out.

Texts are lower-cased (A-Z) and cut into words of digits, letters and characters beyond ASCII.
A benchmark window is ten consecutive words of an item, or all words of a shorter one.

A window of ``k`` words that occurs in a text holds one of the blocks of ``b`` words that start
at every ``k - b + 1``-th word of that text. So the scan hashes such blocks only, probes
the broadcast set of all blocks of the test windows, and verifies each hit by comparing the
windows around it word for word. All of it runs in the task that reads a text; what is
shuffled is a narrow row for each document and hit.

The sets grow with the benchmark, not with the corpus, and are broadcast only after a count
(`broadcast_if_small`); a larger benchmark is met by a shuffle join.

Null texts and texts without words have no hits. Items without words have no window; items
with a null id mark words but are not counted or listed. Repeated items count once, repeated
documents each give a row. An empty benchmark finds nothing. Columns other than ``doc_id`` and
``text`` are kept by :func:`remove`, whatever their names, and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storytide.llm.runtime import stored, whole_rows
from storytide.workspace import broadcast_if_small

WINDOW = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD_BITS = 40


def lower_ascii(text: Column) -> Column:
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _block(k: int) -> tuple[int, int]:
    """Words in a block and the distance of the blocks that cover every window of ``k``."""
    size = max(1, k // 2)
    return size, k - size + 1


def _block_hash(words: str, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, (at + i).cast("int")) for i in range(_block(k)[0])])


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``k, words, window, items``: each distinct window with the ids of its items."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words"))
    items = items.withColumn("n", F.size("words")).where("n > 0").withColumn("k", F.least("n", F.lit(size)))
    starts = items.select("item", "words", "k", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("k"))).alias("s"))
    cut = starts.select("item", "k", F.slice("words", F.col("s") + 1, F.col("k")).alias("words"))
    return cut.groupBy("k", "words").agg(F.collect_set("item").alias("items")).withColumn("window", F.concat_ws(" ", "words"))


def _blocks(found: DataFrame, sizes: list[int]) -> DataFrame:
    parts = [
        found.where(F.col("k") == k)
        .select("words", F.explode(F.sequence(F.lit(0), F.lit(_block(k)[1] - 1))).alias("o"))
        .select(_block_hash("words", F.col("o"), k).alias("block"))
        for k in sizes
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.distinct()


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row for each distinct (``doc_id``, ``text``): ``doc_id, _text_hash, n_rows, n_words``,
    the matched windows as ``spans`` (first word ``s``, words ``k``) and their ``items``.

    ``code`` numbers the places of a text that are probed: the window size in the upper bits,
    the word in the lower ones; -1 stands for the document itself and is always kept.
    """
    found = stored(windows(benchmark, size), "windows")
    sizes = sorted(r.k for r in found.select("k").distinct().collect())
    texts = docs.select(
        "doc_id",
        F.xxhash64("text", F.length("text")).alias("_text_hash"),
        words_of(F.col("text")).alias("words"),
    ).withColumn("n", F.size("words").cast("long"))
    empty = F.array().cast("array<long>")
    own = F.array(F.lit(-1).cast("long"))
    if not sizes:
        rows = texts.withColumns({"s": F.lit(-1).cast("long"), "k": F.lit(0), "items": F.array().cast("array<string>")})
    else:
        places = [own]
        for k in sizes:
            b, step = _block(k)
            base = F.lit(k << _WORD_BITS)
            place = F.sequence(base, base + F.col("n") - b, F.lit(step).cast("long"))
            places.append(F.when(F.col("n") >= k, place).otherwise(empty))
        probes = texts.withColumn("code", F.explode(F.concat(*places)))
        k = F.shiftright("code", _WORD_BITS)
        at = F.col("code").bitwiseAND(F.lit((1 << _WORD_BITS) - 1))
        block = F.lit(None).cast("long")
        for size_k in sizes:
            block = F.when(k == size_k, _block_hash("words", at, size_k)).otherwise(block)
        probes = probes.withColumns({"k": F.when(F.col("code") < 0, 0).otherwise(k.cast("int")), "at": at})
        probes = probes.withColumn("block", block)
        known = broadcast_if_small(_blocks(found, sizes).withColumn("known", F.lit(True)))
        near = probes.join(known, "block", "left").where("code < 0 or known")
        # the windows that hold a block found at `at` in that place of theirs
        step = F.col("k") - F.greatest(F.lit(1), F.floor(F.col("k") / 2)).cast("long") + 1
        first, last = F.greatest(F.col("at") - step + 1, F.lit(0)), F.least(F.col("at"), F.col("n") - F.col("k"))
        starts = F.when(F.col("code") < 0, own).when(first <= last, F.sequence(first, last)).otherwise(empty)
        tried = near.withColumn("s", F.explode(starts))
        text = F.when(F.col("s") >= 0, F.concat_ws(" ", F.slice("words", (F.col("s") + 1).cast("int"), F.col("k"))))
        tried = tried.select("doc_id", "_text_hash", "n", "s", "k", text.alias("window"))
        test = broadcast_if_small(found.select("k", "window", "items"))
        rows = tried.join(test, ["k", "window"], "left").where("s < 0 or items is not null")
    span = F.when(F.col("s") >= 0, F.struct("s", "k"))
    return rows.groupBy("doc_id", "_text_hash").agg(
        F.count_if(F.col("s") < 0).alias("n_rows"),
        F.max("n").alias("n_words"),
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def _covered(spans: str) -> Column:
    """Words inside any of the sorted spans."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total")),
        lambda done, x: F.struct(
            F.greatest(done.end, x.s + x.k).alias("end"),
            (done.total + F.greatest(F.lit(0).cast("long"), x.s + x.k - F.greatest(done.end, x.s))).alias("total"),
        ),
        lambda done: done.total,
    )


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """For every document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    rows = hits(docs, benchmark, size).withColumn("n_hit", _covered("spans"))
    rows = rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))).alias("_copy"),
    )
    return rows.drop("_copy")


def _without(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and the separators before those words."""
    outside = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    inside = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    parts = F.regexp_extract_all(text, F.lit(outside + inside), F.lit(0))
    clean = F.filter(parts, lambda _, i: ~F.exists(spans, lambda x: (i >= x.s) & (i < x.s + x.k)))
    return F.concat(F.array_join(clean, ""), F.regexp_extract(text, outside + r"\z", 0))


def remove(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", size: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents, or (``mode="spans"``) without the hit words.

    Joined by id and text hash, so rows that share an id are judged by their own text.
    """
    if mode not in ("documents", "spans"):
        raise ValueError(f"unknown mode: {mode}")
    bad = hits(docs, benchmark, size).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("_bad_id"), F.col("_text_hash").alias("_bad_hash"), F.col("spans").alias("_spans")
    )
    rows = whole_rows(docs)
    same = F.col("doc_id").eqNullSafe(F.col("_bad_id")) & (F.xxhash64("text", F.length("text")) == F.col("_bad_hash"))
    if mode == "documents":
        return rows.join(bad.drop("_spans"), same, "left_anti").select("row.*")
    kept = rows.join(bad, same, "left")
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("_spans")))
    return kept.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
