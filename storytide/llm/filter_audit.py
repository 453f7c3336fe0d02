"""Filter interaction audit: what each filter removes, for every order of the filters.

A document is one bit mask: which filters it fails. All that an order of filters does to a corpus
follows from how many documents of each mask there are, so a table of any size becomes at most
``2 ** len(filters)`` cells for each part (:func:`cells`: documents, good ones, toxic ones). Each
cell is folded across the array of all orders by higher-order functions: within an order,
``aggregate`` carries whether the cell's documents are still there from step to step and gives a
struct for each; ``transform`` does so for all orders. The arrays of a part's cells (600 structs
for five filters) are merged by elementwise sums, and the share of each filter in all removals
over all orders is summed from the merged array.

Conditions are built-in expressions, evaluated in the task that reads a text (:data:`FILTERS`). Whether
a text is identical to that of a smaller id is decided for its SHA-256, so texts are not moved: the
smallest id of each digest is a partial aggregate, and rows are joined with it by digest *and*
id, a key that no group of copies shares.

Null texts are empty, null sources the empty part. A row whose id is null is not identical to any
smaller id, and no row is to it. Rows with one id and one text are not copies of each other. A
document is good (toxic) if any of its labels says so; without labels, or without an id, it is neither. Empty
tables give no rows. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storytide.llm.runtime import stored

SPACES = " \t\n\x0b\f\r"
FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \t\n\x0B\f\r]+"))


# Failure conditions from the text, its number of words and of distinct words; ``COPY`` is the one
# that looks at other documents.
COPY = "E"
FILTERS: dict[str, Callable[[Column, Column, Column], Column]] = {
    "A": lambda text, words, distinct: words < 50,
    "B": lambda text, words, distinct: 100 * distinct < 65 * words,
    "C": lambda text, words, distinct: 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.length(text),
    "D": lambda text, words, distinct: text.rlike(r"[#$%&*|]"),
}


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``part``, a boolean for each filter, ``good``, ``toxic``."""
    text = F.coalesce("text", F.lit(""))
    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    read = docs.select("doc_id", part, text.alias("text"), _words(text).alias("words"))
    sizes = read.select("*", F.size("words").alias("n"), F.size(F.array_distinct("words")).alias("m"))
    conditions = [test(F.col("text"), F.col("n"), F.col("m")).alias(name) for name, test in FILTERS.items()]
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    rows = stored(sizes.select("doc_id", "part", digest, *conditions), "conditions")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marks = labels.groupBy("doc_id").agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    found = rows.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    no = F.lit(False)
    copy = (F.col("is_first").isNull() & F.col("doc_id").isNotNull()).alias(COPY)
    return found.select("part", *FILTERS, copy, F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def cells(marked_rows: DataFrame, names: list[str]) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each combination of failed filters."""
    bits = sum((F.when(F.col(name), 1 << i).otherwise(0) for i, name in enumerate(names)), F.lit(0))
    count = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    return marked_rows.select("part", bits.alias("mask"), "good", "toxic").groupBy("part", "mask").agg(F.count("*").alias("n"), count("good"), count("toxic"))


def _zero() -> Column:
    return F.lit(0).cast("long")


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once for each row."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _fold(cell: Column, orders: Column) -> Column:
    """One struct for each order and step: what that step does to the documents of the cell."""

    def step(state: Column, bit: Column) -> Column:
        fails = cell.mask.bitwiseAND(bit) != 0
        here = fails & state.there
        there = state.there & ~fails
        weight = lambda test, n: F.when(test, n).otherwise(_zero())
        values = {
            "kept": weight(there, cell.n),
            "removed": weight(here, cell.n),
            "redundant": weight(fails & ~state.there, cell.n),
            "unique_fails": weight(cell.mask == bit, cell.n),
            "good_lost": weight(here, cell.good),
            "toxic_lost": weight(here, cell.toxic),
        }
        row = F.struct(bit.alias("bit"), *[v.alias(k) for k, v in values.items()])
        return F.struct(there.alias("there"), F.concat(state.rows, F.array(row)).alias("rows"))

    kind = ",".join(["bit:int", *[f"{name}:bigint" for name in FIELDS]])
    start = F.struct(F.lit(True).alias("there"), F.array().cast(f"array<struct<{kind}>>").alias("rows"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda state: state.rows)))


def _merge(cells_of_part: Column, orders: Column, size: int) -> Column:
    """The elementwise sums of the folded cells."""
    kind = ",".join(["bit:int", *[f"{name}:bigint" for name in FIELDS]])
    nothing = F.struct(F.lit(0).alias("bit"), *[_zero().alias(name) for name in FIELDS]).cast(f"struct<{kind}>")
    add = lambda x, y: F.struct(y.bit.alias("bit"), *[(x[name] + y[name]).alias(name) for name in FIELDS])
    return F.aggregate(cells_of_part, F.array_repeat(nothing, size), lambda done, cell: F.zip_with(done, _fold(cell, orders), add))


def interactions(found: DataFrame, names: list[str]) -> DataFrame:
    """``part, filter_order, step`` and the counts, from :func:`cells`.

    ``names`` are the filters by bit. A part has at most ``2 ** len(names)`` cells, so gathering
    them in one row is bounded; parts are shared out over tasks. The array of orders is one row,
    made once and sent to every task as the value of a scalar subquery.
    """
    spark = found.sparkSession
    orders = ["".join(order) for order in permutations(names)]
    bits = [[1 << names.index(name) for name in order] for order in orders]
    # Not in the plan as literals: one value that every task gets.
    table = spark.createDataFrame([(bits, orders)], "bits array<array<int>>, names array<string>")
    size = len(orders) * len(names)
    of_part = found.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    with_orders = of_part.withColumns({"bits": table.select("bits").scalar(), "names": table.select("names").scalar()})

    def with_share(rows: Column) -> Column:
        bit = [1 << i for i in range(len(names))]
        share = lambda b: F.aggregate(F.filter(rows, lambda x: x.bit == b), _zero(), lambda n, x: n + x.removed)
        shares = F.map_from_arrays(F.array(*map(F.lit, bit)), F.array(*map(share, bit)))
        add = lambda share: F.transform(rows, lambda x: x.withField("shapley", F.element_at(share, x.bit)))
        return _let(shares, add)

    merged = _let(_merge(F.col("cells"), F.col("bits"), size), with_share)
    rows = with_orders.select("part", "names", F.posexplode(merged).alias("at", "row"))
    order = F.get("names", F.floor(F.col("at") / len(names)).cast("int"))
    return rows.select(
        "part",
        order.alias("filter_order"),
        (F.col("at") % len(names) + 1).cast("int").alias("step"),
        *[F.col(f"row.{name}").alias(name) for name in (*FIELDS, "shapley")],
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All orders of the filters ``A`` to ``E`` on ``docs``, for each source."""
    names = [*FILTERS, COPY]
    return interactions(cells(marked(docs, labels), names), names)
