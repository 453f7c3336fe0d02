"""Book texts from files or tables, and their metadata."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storytide.functions import text as tx
from storytide.operators.chunking import create_chunks
from storytide.operators.joins import restrict_to
from storytide.schema import BOOKS, METADATA, conform
from storytide.functions.stopwords import ENGLISH
from storytide.sources import files as file_tasks
from storytide.sources.tables import CSV_OPTIONS
from storytide.workspace import kept, settings

# Column names of the catalogue file, with the names used here.
CATALOGUE_COLUMNS = {
    "Etext Number": "book_id",
    "Title": "title",
    "Authors": "author",
    "Language": "language",
    "Bookshelves": "bookshelves",
    "Subjects": "subjects",
}
# Fixed value: a book's id is the name of its file.
ID_IN_PATH = "/([^/]+)$"
FILES_TOLD = 1_000  # paths that the driver is told where tasks could read the files by themselves
FILES_READ = 4096  # by a task that reads files by itself, about
FILES_PER_SCAN = 50_000  # paths told to one scan, and rows broadcast beside it
FILES_PER_TASK = 256  # that are read; by itself Spark gives a task 32 small files
LISTING_COST = 1 << 16  # bytes that a file counts for where only its path is looked at, instead of 4 MB


def load_metadata(spark: SparkSession, path: str, language: str | None = "en") -> DataFrame:
    """Catalogue CSV with a header, all columns strings, one language or all.

    A quoted value may hold line breaks.
    """
    raw = spark.read.options(**CSV_OPTIONS).csv(path)
    renamed = raw.select(
        *[F.col(f"`{name}`").alias(alias) for name, alias in CATALOGUE_COLUMNS.items() if name in raw.columns]
    )
    rows = conform(renamed, METADATA).where(F.col("book_id").isNotNull() & (F.col("book_id") != ""))
    return rows.where(F.col("language") == language) if language else rows


def lookup_book(metadata: DataFrame, book_id: str) -> DataFrame:
    """Metadata of one book; blanks around either id are ignored."""
    wanted = F.trim(F.lit(str(book_id)))
    return metadata.where(F.trim("book_id") == wanted).select("book_id", "title", "author")


def spread_small_scan(scan: DataFrame, key: str = "book_id") -> DataFrame:
    """Distribute the texts of a small table over all cores.

    A small Parquet file is one task whatever the size of the cluster. Where the scan has
    fewer splits than there are cores, its rows are hashed by book once; the aggregates
    per chunk and per book then need no shuffle of their own. A large table has splits
    enough and its texts are never moved. ``scan`` must be a plain scan with projections
    and filters, for which counting splits reads nothing.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(2 * cores, key)


def _tasks(spark: SparkSession) -> int:
    return 4 * spark.sparkContext.defaultParallelism


def _listing(spark: SparkSession) -> dict[str, object]:
    """Settings for listings of very many small files: Spark's own cut them into 10,000 tasks, and scans into 32 files a task."""
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism": _tasks(spark), "spark.sql.files.openCostInBytes": LISTING_COST}


def list_books(spark: SparkSession, path: str, id_pattern: str = ID_IN_PATH) -> DataFrame:
    """``book_id, path`` of the files in a folder; no file is opened. Tasks list it where they can (:mod:`files`)."""
    files = file_tasks.list_files(spark, path)
    if files is not None:
        return files.select(F.regexp_extract("path", id_pattern, 1).alias("book_id"), "path")
    with settings(spark, _listing(spark)):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.regexp_extract("path", id_pattern, 1).alias("book_id"), "path")


def _as_glob(path: str) -> str:
    """A path that is read as it stands, not as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _text(strip_markers: bool, fold_newlines: bool) -> Column:
    """The text of a file, decoded and cleaned once."""
    text = tx.decode_utf8(F.col("content"))
    if fold_newlines:
        text = tx.fold_newlines(text)
    return tx.strip_markers(text) if strip_markers else text


def read_listed(listed: DataFrame, strip_markers: bool = True, fold_newlines: bool = False) -> DataFrame:
    """The columns of ``listed`` (``path`` and others) with the ``text`` of each file.

    Only these files are opened. More than ``FILES_TOLD`` are read by tasks that know their paths from the table; few, or
    files on a file system that only Spark reads, by scans whose paths the driver is told, as Spark's own listing of a
    folder does. Everything else stays in tables: those files are read in blocks of about ``FILES_PER_SCAN``, and the columns of a
    block are few enough to be broadcast to the tasks that read it, so texts stay where they are read.
    """
    spark = listed.sparkSession
    with settings(spark, _listing(spark)):
        listed = kept(listed, "listed")
    many = listed.count()
    if many > FILES_TOLD and file_tasks.can_read(listed):
        columns = [c for c in listed.columns if c != "path"]
        return file_tasks.read_files(listed, FILES_READ).select(*columns, _text(strip_markers, fold_newlines).alias("text"))
    blocks = -(-many // FILES_PER_SCAN)
    number = F.pmod(F.xxhash64("path"), F.lit(max(1, blocks)))
    text = _text(strip_markers, fold_newlines).alias("text")
    columns = [c for c in listed.columns if c != "path"]
    parts = []
    for i in range(blocks):
        mine = listed.where(number == i)
        paths = [_as_glob(row.path) for row in mine.select("path").distinct().toLocalIterator()]
        if paths:
            with settings(spark, _listing(spark)):
                files = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"), "content")
            # Fewer tasks than Spark's own: it counts 4 MB for a file, so a task would have 32 of them.
            files = files.coalesce(max(_tasks(spark), len(paths) // FILES_PER_TASK))
            parts.append(files.join(F.broadcast(mine), F.col("file") == F.col("path")).select(*columns, text))
    empty = listed.select(*columns, F.lit(None).cast("string").alias("text")).limit(0)
    return reduce(DataFrame.unionByName, parts) if parts else empty


def load_books(
    spark: SparkSession,
    path: str,
    id_pattern: str = ID_IN_PATH,
    strip_markers: bool = True,
    fold_newlines: bool = False,
) -> DataFrame:
    """``book_id, text`` from one file per book."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    text = _text(strip_markers, fold_newlines)
    return files.select(F.regexp_extract("path", id_pattern, 1).alias("book_id"), text.alias("text"))


def read_book(spark: SparkSession, books_path: str, book_id: str, id_pattern: str = ID_IN_PATH) -> DataFrame:
    """``book_id, text`` of one book, line ends folded. A missing file is an error."""
    return load_books(spark, f"{books_path.rstrip('/')}/{_as_glob(book_id)}", id_pattern, fold_newlines=True)


def load_listed_books(
    spark: SparkSession,
    books_path: str,
    metadata: DataFrame,
    ids: DataFrame | None = None,
    limit: int | None = None,
    id_pattern: str = ID_IN_PATH,
) -> DataFrame:
    """The books of a catalogue with title, author and text.

    The files are listed first and joined with the catalogue by the ids in their names; only
    what is left is read. ``ids`` (a frame with ``book_id``) picks books and wins over ``limit``.
    """
    named = metadata.select("book_id", "title", "author")
    if ids is not None:
        named = restrict_to(named, ids)
    elif limit:
        named = named.orderBy("book_id").limit(limit)
    return conform(read_listed(list_books(spark, books_path, id_pattern).join(named, "book_id")), BOOKS)


def load_and_chunk_books(
    spark: SparkSession,
    books_path: str,
    metadata_path: str,
    num_chunks: int = tx.DEFAULT_CHUNKS,
    language: str | None = "en",
    limit: int | None = None,
    ids: DataFrame | None = None,
    id_pattern: str = ID_IN_PATH,
    stop_words: Sequence[str] = ENGLISH,
) -> DataFrame:
    """Files to chunks of words, for the books of the catalogue (see :func:`load_listed_books`)."""
    metadata = load_metadata(spark, metadata_path, language)
    books = load_listed_books(spark, books_path, metadata, ids, limit, id_pattern)
    return create_chunks(books, num_chunks, stop_words)


def load_text_files(spark: SparkSession, path: str, id_pattern: str = ID_IN_PATH) -> DataFrame:
    """Ad-hoc text files as a corpus; the title is the file name in words."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.regexp_extract("path", id_pattern, 1)
    return files.select(
        name.alias("book_id"),
        F.replace(F.replace(name, F.lit(".txt"), F.lit("")), F.lit("_"), F.lit(" ")).alias("title"),
        F.lit("File Input").alias("author"),
        tx.fold_newlines(tx.decode_utf8(F.col("content"))).alias("text"),
    )
