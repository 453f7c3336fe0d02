"""Trajectory tables, exports, reports and fitted models on shared storage."""

from __future__ import annotations

from pyspark.ml.clustering import LocalLDAModel
from pyspark.ml.feature import CountVectorizerModel, Word2VecModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from storytide.schema import TRAJECTORY, conform

# Directory of each kind of model.
MODEL_READERS = {
    "word2vec": Word2VecModel,
    "lda": LocalLDAModel,
    "count_vectorizer": CountVectorizerModel,
}


# Query books are looked up by id: with a Bloom filter on the id, a lookup skips the row
# groups that cannot hold it.
LOOKUP_OPTIONS = {
    "parquet.bloom.filter.enabled#book_id": True,
    "parquet.bloom.filter.expected.ndv#book_id": 100_000,
}


def save_trajectories(trajectories: DataFrame, path: str, mode: str = "overwrite") -> None:
    conform(trajectories).write.options(**LOOKUP_OPTIONS).mode(mode).parquet(path)


def load_trajectories(spark: SparkSession, path: str) -> DataFrame:
    """Stored trajectories in the fixed schema; older files may lack optional columns."""
    return spark.read.schema(TRAJECTORY).parquet(path).select(TRAJECTORY.names)


# Number of folders of a sink that grows by small batches. A batch reads those of its ids only.
SINK_BUCKETS = 64
BUCKET = "bucket"


def bucket_of(book_id: str = "book_id", buckets: int = SINK_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(book_id), F.lit(buckets)).cast("int")


def append_to_sink(trajectories: DataFrame, path: str, buckets: int = SINK_BUCKETS) -> None:
    """Add rows to a sink, one file for each bucket they fall into.

    The number of buckets is a property of a sink: it must not change while it grows, and a folder that
    :func:`save_trajectories` wrote is no sink.
    """
    rows = conform(trajectories).withColumn(BUCKET, bucket_of(buckets=buckets))
    spread = rows.repartition(buckets, BUCKET)
    spread.write.options(**LOOKUP_OPTIONS).mode("append").partitionBy(BUCKET).parquet(path)


def stored_ids(spark: SparkSession, path: str, ids: DataFrame, buckets: int = SINK_BUCKETS) -> DataFrame:
    """The ids of a sink that are among ``ids``, read from the folders of their buckets alone.

    At most ``buckets`` numbers are told to the driver: the partition filter of the scan.
    """
    mine = sorted(row[0] for row in ids.select(bucket_of(buckets=buckets)).distinct().collect() if row[0] is not None)
    stored = spark.read.schema(T.StructType([TRAJECTORY["book_id"], T.StructField(BUCKET, T.IntegerType())])).parquet(path)
    return stored.where(F.col(BUCKET).isin(mine)).select("book_id")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at ``path``, on any file system. Other errors are raised."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


# Values come back with their outer blanks, quotes and line breaks. An empty string comes
# back as missing: a CSV reader cannot tell them apart.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def export_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header. Nested columns are written as JSON, which CSV can hold."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    flat = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in rows.schema
    ]
    rows.select(flat).write.options(**CSV_OPTIONS).mode("overwrite").csv(path)


def import_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back :func:`export_csv` output; ``schema`` tells which columns were nested."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    flat = T.StructType(
        [T.StructField(f.name, T.StringType() if isinstance(f.dataType, nested) else f.dataType) for f in schema]
    )
    rows = spark.read.schema(flat).options(**CSV_OPTIONS).csv(path)
    return rows.select(
        [
            F.from_json(f.name, f.dataType).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in schema
        ]
    )


def save_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def save_models(models: dict, directory: str) -> None:
    """Write each fitted model to its own subdirectory; absent ones are skipped."""
    for name, model in models.items():
        if model is not None:
            model.write().overwrite().save(f"{directory}/{name}")


def load_models(spark: SparkSession, directory: str) -> dict:
    """The models that are stored. One that is stored but unreadable raises."""
    return {
        name: reader.load(f"{directory}/{name}")
        for name, reader in MODEL_READERS.items()
        if exists(spark, f"{directory}/{name}")
    }


def export_name(name: str, text_file: str | None = None) -> str:
    """Under which name a result for a book or a text file is saved: without path separators, and for
    a text file its own name in words."""
    # The id that stands for a text file, and the beginning of the name.
    if name == "text_file" and text_file:
        base = text_file.replace("\\", "/").rsplit("/", 1)[-1]
        cleaned = base.replace(".txt", "").replace("_", " ")
    else:
        cleaned = name.replace("/", "_").replace("\\", "_")
    return f"recommendations_for_{cleaned}"
