"""What all operators share: reading tables, scratch tables, shipping this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storytide.operators.joins import restrict_to
from storytide.workspace import fresh_path

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application.

    Also bounds the batches that go to them by size for the rest of the session, as a batch of long
    texts may be large.
    """
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="storytide-"), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` whose ``name`` is among ``ids``; texts are not shuffled for it.

    A list too long to be broadcast is sent as a bitmap, as for books.
    """
    found = restrict_to(docs.withColumnRenamed(name, "book_id"), ids.select(F.col(name).alias("book_id")))
    return found.withColumnRenamed("book_id", name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out. A null id is in fold 1."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)), F.lit(1))


def whole_rows(docs: DataFrame) -> DataFrame:
    """``row`` (all columns as one struct), ``doc_id`` and ``text``: whatever the columns are named, they
    cannot be taken for those that an operator adds. ``select("row.*")`` gives them back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")


def with_key(docs: DataFrame, name: str = "doc") -> DataFrame:
    """``docs`` (without other columns named like ``name``) with a number for each document that orders them by id.

    The id itself, unless an id is missing, is not a number of 62 bits or stands for several texts: then
    the place among the distinct (id, text hash) pairs, nulls last.
    """
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    text_hash = F.xxhash64("text")
    pairs = docs.groupBy("doc_id").agg(F.min(text_hash).alias("x"), F.max(text_hash).alias("y"))
    if whole and pairs.where(f"doc_id is null or x != y or abs(doc_id) >= {1 << 61}").isEmpty():
        return docs.withColumn(name, F.col("doc_id").cast("long"))
    distinct = docs.select(F.col("doc_id").alias("_id"), text_hash.alias("_hash")).distinct()
    order = [F.col("_id").asc_nulls_last(), F.col("_hash")]
    ordered = distinct.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    numbered = stored(ordered.withColumn(name, F.monotonically_increasing_id()), "doc_order")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (text_hash == F.col("_hash"))
    return docs.join(numbered, same).drop("_id", "_hash")
