"""Joins that decide which books take part."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storytide.workspace import MAX_BROADCAST_ROWS, broadcast_if_small

# Titles and author names are wider than ids, so fewer rows may be broadcast.
MAX_METADATA_ROWS = MAX_BROADCAST_ROWS // 4
# A set of ids that is sent as a bitmap has so many bits for each id, and at most 256 MB: one
# id in sixteen passes by mistake up to 134 million ids, more of them beyond.
BITS_PER_ID = 16
MAX_FILTER_BITS = 1 << 31


def catalogued(books: DataFrame, metadata: DataFrame) -> DataFrame:
    """The books that the catalogue lists, without title and author; texts stay where they are."""
    return restrict_to(books.drop("title", "author"), metadata)


def attach_names(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """Title and author of each row's book; a book listed twice gives a row for each.

    The rows are shuffled where the catalogue is too large for a broadcast, so they should be
    results and not texts.
    """
    names = metadata.select("book_id", "title", "author")
    return rows.drop("title", "author").join(broadcast_if_small(names, MAX_METADATA_ROWS), "book_id")


def join_metadata(
    books: DataFrame, metadata: DataFrame, narrow: Callable[[DataFrame], DataFrame] = lambda books: books
) -> DataFrame:
    """What ``narrow`` makes of the books of the catalogue, with title and author.

    Names are attached last, to the rows that ``narrow`` gives (they must have ``book_id``), so
    that only those are shuffled for a catalogue of any size.
    """
    return attach_names(narrow(catalogued(books, metadata)), metadata)


def _filter_bits(ids: int) -> int:
    return min(MAX_FILTER_BITS, 1 << max(15, (BITS_PER_ID * ids - 1).bit_length()))


def _bitmap(ids: DataFrame, bits: int, column: str) -> DataFrame:
    """A set of ids as ``bucket, bits``: one hash, ``bits`` bits in rows of 4 KB.

    Its size has a fixed bound, so it may always be broadcast. An id of the set is always
    found; one outside of it is found with a chance that grows with the set.
    """
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    placed = ids.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    return placed.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _with_hint(books: DataFrame, ids: DataFrame, bits: int, column: str = "book_id") -> DataFrame:
    """``books`` with ``_maybe``: false only if the id is not in ``ids``. Texts stay in place."""
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    bit = F.bitmap_bit_position(place)
    marked = books.withColumns({"bucket": F.bitmap_bucket_number(place), "_bit": bit})
    joined = marked.join(F.broadcast(_bitmap(ids, bits, column)), "bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(bits, int(_bit div 8) + 1, 1)")), 16, 10).cast("int")
    hint = F.expr("shiftleft(1, int(_bit % 8))").bitwiseAND(byte) != 0
    return joined.withColumn("_maybe", F.coalesce(hint, F.lit(False))).drop("bucket", "_bit", "bits")


def likely_in(rows: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is among ``values``, and few others: nothing is shuffled for it."""
    return _with_hint(rows, values, _filter_bits(values.count()), column).where("_maybe").drop("_maybe")


def restrict_to(books: DataFrame, ids: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Books whose id occurs in ``ids``.

    A list too long to be broadcast is sent as a bitmap. Books that the bitmap lets through
    by mistake are found on the ids alone and taken out by their list.
    """
    ids = ids.select("book_id").where("book_id IS NOT NULL")
    n = ids.count()
    if n <= max_rows:
        return books.join(F.broadcast(ids), "book_id", "left_semi")
    passed = _with_hint(books, ids, _filter_bits(n)).where("_maybe").drop("_maybe")
    wrong = passed.select("book_id").join(ids, "book_id", "left_anti").distinct()
    return passed.join(broadcast_if_small(wrong), "book_id", "left_anti")


def pending_books(books: DataFrame, done: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Books that have no output yet; a book without an id has none.

    A long list of done ids is sent as a bitmap: most pending books pass it at once. Those
    that it holds back by mistake are found on the ids alone and let through by their list.
    """
    done = done.select("book_id").where("book_id IS NOT NULL")
    n = done.count()
    if n <= max_rows:
        return books.join(F.broadcast(done), "book_id", "left_anti")
    hinted = _with_hint(books, done, _filter_bits(n))
    held = hinted.where("_maybe").select("book_id").join(done, "book_id", "left_anti").distinct()
    free = broadcast_if_small(held.withColumn("_free", F.lit(True)))
    return hinted.join(free, "book_id", "left").where("NOT _maybe OR _free").drop("_maybe", "_free")


def training_order(book_id: str = "book_id", seed: int = 42):
    """A reproducible shuffle key that does not depend on partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(book_id)))


def training_sample(books: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """The ids of the first ``size`` books in shuffled order: the batch that models are fitted on.

    A histogram of the leading digits of the shuffle key tells in which bin the sample ends. What
    lies in the bins before belongs to it; only the rows of that bin are ordered. So no
    task gathers the sample, however large it is.
    """
    key = training_order(seed=seed)
    bin_of = F.coalesce(F.conv(F.substring(key, 1, 4), 16, 10).cast("int"), F.lit(-1))  # a null id comes first
    rows = books.select("book_id", bin_of.alias("bin"))
    # Four hexadecimal digits: at most 65,537 rows reach the one task of this window.
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = rows.groupBy("bin").agg(F.count("*").alias("n"))
    bins = bins.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    cut = bins.where((F.col("before") < size) & (F.col("before") + F.col("n") >= size)).first()
    if cut is None:  # fewer rows than asked for, or none asked for
        return books.select("book_id") if size > 0 else books.select("book_id").limit(0)
    whole = rows.where(F.col("bin") < cut.bin).select("book_id")
    rest = rows.where(F.col("bin") == cut.bin).select("book_id")
    return whole.union(rest.orderBy(key, "book_id").limit(size - cut.before))


def assign_batches(books: DataFrame, batches: int, seed: int = 42) -> DataFrame:
    """Number each book with one of ``batches`` even, reproducible, shuffled batches.

    The batch follows from the id alone, so no global numbering is needed.
    """
    digits = F.conv(F.substring(training_order(seed=seed), 1, 8), 16, 10).cast("bigint")
    return books.withColumn("batch", F.pmod(digits, F.lit(batches)).cast("int"))
