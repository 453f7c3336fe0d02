"""Books that keep arriving, scored in micro-batches and appended once."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from storytide.functions import text as tx
from storytide.plans.corpus import Lexicons, enriched_trajectories
from storytide.operators.joins import pending_books, restrict_to
from storytide.operators.trajectory import dedupe_books
from storytide.schema import BOOKS
from storytide.sources.tables import append_to_sink, exists, stored_ids
from storytide.workspace import MAX_BROADCAST_ROWS, kept


def book_stream(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """New Parquet files of books under ``path``, a bounded number per micro-batch."""
    return spark.readStream.schema(BOOKS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def without_stored(spark: SparkSession, batch: DataFrame, sink: str) -> DataFrame:
    """The rows of ``batch`` whose book the sink does not hold yet.

    The sink grows without end and the batch does not: only the buckets of the batch's ids are
    read, and what is found there comes back as a list no longer than the batch. It is stored before
    the sink grows. Texts are not moved for it.
    """
    if not exists(spark, sink):
        return batch
    present = restrict_to(stored_ids(spark, sink, batch), batch, MAX_BROADCAST_ROWS).distinct()
    return pending_books(batch, kept(present, "present"))


def spread(pending: DataFrame, batch: DataFrame) -> DataFrame:
    """Books dealt by id over all cores, where the files of their batch are fewer: a batch may be a few large files."""
    cores = batch.sparkSession.sparkContext.defaultParallelism
    return pending if batch.rdd.getNumPartitions() >= cores else pending.repartition(2 * cores, "book_id")


def commit_path(sink: str, progress: str, batch_id: int) -> str:
    """The marker of a batch that is in the sink. Batches are numbered by the progress folder that a
    stream keeps, so markers of another one do not count. Readers of the sink skip the folder."""
    stream = hashlib.sha256(progress.encode()).hexdigest()[:16]
    return f"{sink.rstrip('/')}/_committed/{stream}/{batch_id}"


def append_batch(
    batch: DataFrame,
    sink: str,
    lexicons: Lexicons,
    models: dict | None = None,
    num_chunks: int = tx.DEFAULT_CHUNKS,
    marker: str | None = None,
) -> None:
    """Score the books of a micro-batch that the sink lacks, and append them.

    With ``marker``, a batch that was appended before is not even read. One that failed after or during
    its append finds its own rows in the sink and adds only the rest. Ids are checked before texts are
    scored, so that nothing is scored that the sink holds. All cores take part, however few the files are; with models the chunks of words are written,
    so that texts are cut once.
    """
    spark = batch.sparkSession
    if marker and exists(spark, marker):
        return
    pending = spread(without_stored(spark, batch, sink), batch)
    scored = kept(dedupe_books(enriched_trajectories(pending, lexicons, models, num_chunks)), "batch")
    append_to_sink(scored, sink)
    if marker:
        spark.range(1).write.mode("overwrite").parquet(marker)


def ingest(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    lexicons: Lexicons,
    models: dict | None = None,
    num_chunks: int = tx.DEFAULT_CHUNKS,
    files_per_batch: int = 1000,
) -> None:
    """Process everything that has arrived since the last call, then return.

    Progress lives in ``checkpoint``; calling again picks up new files only.
    """
    query = (
        book_stream(spark, source, files_per_batch)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(
            lambda batch, number: append_batch(batch, sink, lexicons, models, num_chunks, commit_path(sink, checkpoint, number))
        )
        .start()
    )
    query.awaitTermination()
