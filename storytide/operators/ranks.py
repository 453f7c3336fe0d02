"""Elements by their place in the order of all values, and the best rows of each key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storytide.workspace import kept

HELD_ROWS = 1 << 16  # that a task collects before it drops what cannot be among the best


def values_at(rows: DataFrame, column: str, places: dict[str, tuple[int, int]], ties: Sequence[str] = ()) -> DataFrame:
    """One row with the element at place ``n * a // b`` of the ordered values, for each name and (a, b).

    Values are cut into ranges over all tasks, and the ranges are counted. The running sum of the
    counts tells which range holds a place; only those ranges are ordered, and one row of
    each is taken. ``ties`` are columns that split a value which very many rows have. Nulls do
    not count; without values the elements are null.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    split = [column, *([F.xxhash64(*ties)] if ties else [])]
    spread = rows.where(F.col(column).isNotNull()).repartitionByRange(parts, *split)
    ranges = kept(spread.select(F.col(column).alias("value"), F.spark_partition_id().alias("part")), "ranges")
    # One row for each range reaches the task of this window.
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("part").agg(F.count("*").alias("n"))
    sizes = sizes.select(
        "part", "n", F.sum("n").over(every).alias("total"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    wanted = [F.struct(F.lit(name).alias("name"), F.expr(f"total * {a} div {b}").alias("place")) for name, (a, b) in places.items()]
    asked = sizes.select("part", "n", "before", F.explode(F.array(*wanted)).alias("asked"))
    inside = F.col("asked.place") - F.col("before")
    found = asked.select("part", "asked.name", inside.alias("inside"), "n").where("inside >= 0 AND inside < n").drop("n")
    order = Window.partitionBy("part", "name").orderBy("value")
    ordered = ranges.join(F.broadcast(found), "part").withColumn("at", F.row_number().over(order) - 1)
    chosen = ordered.where("at = inside")
    return chosen.agg(*[F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in places])


def numbered(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``rows`` with their place in an order, from 0: ranges over all tasks, counted, and numbered
    behind the ranges before. ``order`` must tell all rows apart."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = kept(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ordered")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sizes = ranges.groupBy("part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    placed = ranges.withColumn("inside", inside).join(F.broadcast(sizes.drop("n")), "part")
    return placed.withColumn(name, F.col("before") + F.col("inside")).drop("part", "inside", "before")


def _window_limit(rows: DataFrame) -> int:
    """Up to which rank Spark cuts a ranking inside each task, before the shuffle."""
    return int(rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def _best_of_task(rows: DataFrame, keys: Sequence[str], order: Sequence[str], top_n: int) -> DataFrame:
    """The rows that may be among the best of their key, at most ``top_n`` of a key from each task.

    ``order``: the score, highest first, then columns that decide between equal ones. A task holds
    the best rows so far and a buffer; when that is full, all but the best are dropped.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        sorting = [*((key, "ascending") for key in keys), (order[0], "descending"), *((c, "ascending") for c in order[1:])]

        def cut(parts: list):
            table = pa.Table.from_batches(parts).combine_chunks()
            table = table.take(pc.sort_indices(table, sort_keys=sorting))
            first = np.zeros(table.num_rows, bool)
            first[:1] = True
            for key in keys:
                codes = table.column(key).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
                first[1:] |= codes[1:] != codes[:-1]
            at = np.arange(table.num_rows)
            rank = at - np.maximum.accumulate(np.where(first, at, 0))
            return table.filter(pa.array(rank < top_n))

        held: list = []
        size = bound = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= bound + HELD_ROWS:
                best = cut(held)
                held, size = best.to_batches(), best.num_rows
                bound = size
        if held:
            yield from cut(held).to_batches()

    return rows.mapInArrow(run, rows.schema)


def top_per(rows: DataFrame, keys: Sequence[str], order: list[Column], top_n: int) -> DataFrame:
    """The best ``top_n`` rows of each key by ``order`` (a score, highest first, then a name) with their ``rank``.

    Each task keeps its own best rows before the shuffle, so a key's task receives
    ``top_n`` rows from each task and not the whole group. Spark does so by itself for short
    lists; for longer ones the tasks cut their rows in Arrow batches.
    """
    if top_n > _window_limit(rows):
        score, name = order
        named = rows.withColumns({"_score": score, "_name": name})
        rows = _best_of_task(named, keys, ("_score", "_name"), top_n)
        window = Window.partitionBy(*keys).orderBy(F.desc("_score"), "_name")
        return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top_n).drop("_score", "_name")
    window = Window.partitionBy(*keys).orderBy(order[0].desc(), order[1].asc())
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top_n)
