"""Where intermediate tables go, and the size checks that guard broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bounds for what may be sent whole to every executor. Lexicons and id lists
# are narrow (about a hundred bytes a row), so a million rows stay near 100 MB.
MAX_BROADCAST_ROWS = 1_000_000

DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": True}

_fallback: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or the checkpoint
    folder of the context.

    Only a local session that has neither gets a temporary one; elsewhere that is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = context.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="storytide-")
        context.setCheckpointDir(_fallback[app])
    return _fallback[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/storytide/{uuid.uuid4().hex}/{name}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, whoever is lost later.

    What was shuffled for it is dropped at once; by itself Spark keeps it until the driver collects garbage.
    """
    path = fresh_path(df.sparkSession, name)
    with settings(df.sparkSession, DROP_SHUFFLES):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    """Settings of the session that hold inside the block: for what is listed, planned or run there."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def within(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows.

    A plain count: every task sends one number, whereas a limit would first gather up to
    ``max_rows`` rows of every task in one place.
    """
    return df.count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; otherwise leave the join to shuffle."""
    return F.broadcast(df) if within(df, max_rows) else df
