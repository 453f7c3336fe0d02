"""Quality rules: counts with fixed limits, then robust multivariate outliers.

Every text is counted (:func:`with_counts`). A text with fewer than 50 words, or half of whose
words lie in three-word windows that come twice, fails at once. For the others five transformed
statistics are compared with the other documents of the same language and source, by the
Mahalanobis distance from a minimum-covariance-determinant estimate: location and
covariance of the three quarters of the documents that lie closest together.

Three first estimates (medians and quartiles, the inner half, all) are refined by concentration steps:
take the nearest three quarters, take their mean and covariance, repeat until the determinants
stand still. The estimate with the smallest determinant counts. Quantiles are exact ones of
values rounded to bins, so an aggregation keeps some hundred counters for a group, and its
result does not depend on the order of rows. Equal statistic vectors count once in the
estimates, so copies, however many, cannot pass for the bulk of a source; every statistic has
a least variance (``FLOOR``). A document is rejected if it is far from the estimate of its source
*and* from that of its language. Groups of fewer than ``LEAST_ROWS`` distinct vectors have no
estimate of their own; without any estimate a document is kept.

Null texts are empty and fail. Null languages and sources are groups of their own. Repeated
rows are judged one by one. An empty table gives an empty result. All work is done by
built-in expressions; other columns are carried along by :func:`keep_good`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storytide.llm.runtime import stored
from storytide.workspace import broadcast_if_small

MIN_WORDS = 50
SHARE = 0.75  # of the documents that an estimate rests on
MAX_STEPS = 12
SETTLED = 0.01  # change of the logarithm of a determinant
LEAST_ROWS = 40
# Squared. The 0.9999 quantile of five normal statistics is 26, but shares of repeated words have long tails in
# clean text: documents labelled good reach 86 in the test tables, labelled junk begins at 220.
MAX_DISTANCE = 95.0
MEDIAN_CHI2 = 4.351  # of five degrees of freedom
# Least standard deviations of the statistics: each alone can reach the limit.
FLOOR = (0.15, 0.04, 0.1, 0.07, 0.06)

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
GROUP = ["level", "lang", "source"]  # level 1 joins all sources of a language
_N = len(FLOOR)
_DIMS = range(_N)


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once for each row."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice.

    A window is one number: its hash in the upper bits, its place in the lower ones (as many as
    the text needs). Sorted, equal windows stand side by side; the windows themselves
    are then compared, so that equal hashes alone do not count.
    """
    long0 = F.lit(0).cast("long")

    def count(ws: Column) -> Column:
        return _let(F.length(F.bin(F.size(ws))), lambda bits: count_in(ws, bits))

    def count_in(ws: Column, bits: Column) -> Column:
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        places = F.sequence(long0, F.size(ws).cast("long") - 3)

        def window(i: Column) -> Column:
            i = i.cast("int")
            return F.struct(F.get(ws, i).alias("a"), F.get(ws, i + 1).alias("b"), F.get(ws, i + 2).alias("c"))

        def coded(i: Column) -> Column:
            at = i.cast("int")
            h = F.xxhash64(F.get(ws, at), F.get(ws, at + 1), F.get(ws, at + 2))
            return F.call_function("shiftleft", h, bits).bitwiseOR(i)

        def same(x: Column, y: Column) -> Column:
            near = F.call_function("shiftright", x, bits) == F.call_function("shiftright", y, bits)
            return F.coalesce(near & (window(x.bitwiseAND(mask)) == window(y.bitwiseAND(mask))), F.lit(False))

        def twice(codes: Column) -> Column:
            kept = F.filter(codes, lambda x, i: same(x, F.get(codes, i + 1)) | same(x, F.get(codes, i - 1)))
            return F.sort_array(F.transform(kept, lambda x: x.bitwiseAND(mask)))

        def covered(at: Column) -> Column:
            step = F.struct(F.lit(-3).cast("long").alias("last"), long0.alias("n"))
            add = lambda done, x: F.struct(x.alias("last"), (done.n + F.least(F.lit(3).cast("long"), x - done.last)).alias("n"))
            return F.aggregate(at, step, add, lambda done: done.n)

        found = _let(_let(F.sort_array(F.transform(places, coded)), twice), covered)
        return F.when(F.size(ws) < 4, long0).otherwise(found)

    return _let(words, count)


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct ``_q``: the five counts and the share of upper-case letters."""
    text = F.coalesce(F.col("text"), F.lit(""))
    only = lambda kept: F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    bare = F.btrim(text, F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \t\n\x0B\f\r]+"))
    base = docs.withColumns({"_words": words, "_lines": lines})
    counts = {
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": only(SYMBOLS),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": _repeated_words(F.col("_words")),
        "n_lines": F.size("_lines").cast("long"),
        "n_upper": only("A-Z"),
    }
    return base.withColumn("_q", F.struct(*[v.alias(k) for k, v in counts.items()])).drop("_words", "_lines")


def _failed() -> Column:
    return (F.col("_q.n_words") < MIN_WORDS) | (100 * F.col("_q.n_repeat_words") > 50 * F.col("_q.n_words"))


def _with_vector(counted: DataFrame) -> DataFrame:
    """The transformed statistics: length of words, symbols, repeated lines and words, capitals."""
    n = F.greatest(F.col("_q.n_words"), F.lit(1))
    values = (
        F.log(F.greatest(F.col("_q.word_chars"), F.lit(1)) / n),
        F.sqrt(F.col("_q.n_symbols") / n),
        F.sqrt(F.col("_q.n_dup_lines") / F.greatest(F.col("_q.n_lines"), F.lit(1))),
        F.sqrt(F.col("_q.n_repeat_words") / n),
        F.sqrt(F.col("_q.n_upper") / F.greatest(F.col("_q.word_chars"), F.lit(1))),
    )
    vector = F.struct(*[F.round(v, 4).alias(f"x{i}") for i, v in enumerate(values)])
    keys = F.struct(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))
    return counted.withColumns({"_x": vector, "_g": keys})


def _scaled_distance(prefix: str = "") -> Column:
    """The squared Mahalanobis distance by the inverse Cholesky factor ``p``."""
    d = [F.col(f"x{i}") - F.col(f"{prefix}c{i}") for i in _DIMS]
    rows = [sum((F.col(f"{prefix}p{i}{j}") * d[j] for j in range(i + 1)), F.lit(0.0)) for i in _DIMS]
    return sum((y * y for y in rows), F.lit(0.0)) / F.col(f"{prefix}factor")


def _with_factor(estimates: DataFrame) -> DataFrame:
    """The inverse ``p`` of the Cholesky factor ``l`` of each covariance ``s``, entry by entry."""
    out = estimates
    for j in _DIMS:
        rest = {
            i: F.col(f"s{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            for i in range(j, _N)
        }
        top = F.sqrt(F.greatest(rest[j], F.lit(FLOOR[j] ** 2 / 4)))
        out = out.withColumns({f"l{i}{j}": top if i == j else rest[i] / top for i in rest})
    for i in _DIMS:
        row = {
            j: -sum((F.col(f"l{i}{k}") * F.col(f"p{k}{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l{i}{i}")
            for j in range(i)
        }
        out = out.withColumns({f"p{i}{j}": v for j, v in row.items()} | {f"p{i}{i}": 1 / F.col(f"l{i}{i}")})
    return out.drop(*[c for c in out.columns if c[0] in "ls" and c[1:].isdigit()])


def _with_determinant(estimates: DataFrame) -> DataFrame:
    """The logarithm of the determinant of each covariance, from its factor."""
    return estimates.withColumn("det", -2 * sum((F.log(F.col(f"p{i}{i}")) for i in _DIMS), F.lit(0.0)))


def _first_estimate(rows: DataFrame) -> DataFrame:
    """Medians, and the quartile ranges as a diagonal covariance."""
    parts = [F.percentile(F.round(f"x{i}", 2), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"m{i}") for i in _DIMS]
    found = rows.groupBy(GROUP).agg(F.count("*").alias("n"), *parts).where(F.col("n") >= LEAST_ROWS)
    columns = {f"c{i}": F.get(f"m{i}", F.lit(1)) for i in _DIMS}
    for i in _DIMS:
        scale = F.greatest((F.get(f"m{i}", F.lit(2)) - F.get(f"m{i}", F.lit(0))) / 1.349, F.lit(FLOOR[i]))
        columns |= {f"s{i}{j}": scale * scale if i == j else F.lit(0.0) for j in range(i + 1)}
    columns["factor"] = F.lit(1.0)
    return _with_factor(found.select(*GROUP, *[v.alias(k) for k, v in columns.items()]))


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and covariance of the rows of each key, with the least variances added, as an estimate."""
    means = [F.avg(f"x{i}").alias(f"c{i}") for i in _DIMS]
    cross = [F.avg(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"r{i}{j}") for i in _DIMS for j in range(i + 1)]
    found = rows.groupBy(keys).agg(*means, *cross)
    columns = {f"c{i}": F.col(f"c{i}") for i in _DIMS} | {"factor": F.lit(1.0)}
    for i in _DIMS:
        for j in range(i + 1):
            s = F.col(f"r{i}{j}") - F.col(f"c{i}") * F.col(f"c{j}")
            columns[f"s{i}{j}"] = F.greatest(s, F.lit(0.0)) + FLOOR[i] ** 2 if i == j else s
    return _with_factor(found.select(*keys, *[v.alias(k) for k, v in columns.items()]))


def _starts(rows: DataFrame) -> DataFrame:
    """Three estimates for each group to begin with: medians and quartiles; the half of the rows
    whose largest scaled deviation from them is smallest; all rows."""
    first = stored(_first_estimate(rows), "medians")
    known = rows.join(broadcast_if_small(first), GROUP)
    # the covariance of the first is diagonal, so its factor holds the scales
    far = F.greatest(*[F.abs((F.col(f"x{i}") - F.col(f"c{i}")) * F.col(f"p{i}{i}")) for i in _DIMS])
    boxed = known.select(*GROUP, *[f"x{i}" for i in _DIMS], F.round(far, 2).alias("d"))
    half = boxed.join(broadcast_if_small(boxed.groupBy(GROUP).agg(F.percentile("d", 0.5).alias("limit"))), GROUP).where("d <= limit")
    found = [first, _moments(half, GROUP), _moments(boxed, GROUP)]
    parts = [_with_determinant(part).withColumn("start", F.lit(k)) for k, part in enumerate(found)]
    return stored(parts[0].unionByName(parts[1]).unionByName(parts[2]), "starts")


def estimate(rows: DataFrame) -> DataFrame:
    """Location ``c``, inverse Cholesky factor ``p`` and scale ``factor`` for each group.

    ``rows`` hold distinct vectors ``x0`` to ``x4``. A concentration step aggregates the rows twice: for
    the distance within which the wanted share lies, and for mean and covariance there. It is
    repeated for all starts until no determinant changes; of the results of a group the one
    with the smallest determinant counts. ``factor`` makes the median of the squared distances that
    of normal data where it is larger.
    """
    keys = [*GROUP, "start"]
    now = _starts(rows)
    for step in range(MAX_STEPS):
        near = rows.join(broadcast_if_small(now.drop("det")), GROUP).withColumn("d", F.round(F.log1p(_scaled_distance()), 2))
        limits = broadcast_if_small(near.groupBy(keys).agg(F.percentile("d", SHARE).alias("limit")))
        inner = near.join(limits, keys).where(F.col("d") <= F.col("limit"))
        before = broadcast_if_small(now.select(*keys, F.col("det").alias("before")))
        fresh = stored(_with_determinant(_moments(inner, keys)).join(before, keys), f"estimate{step}")
        change = fresh.agg(F.max(F.abs(F.col("det") - F.col("before")))).first()[0]
        now = fresh.drop("before")
        if change is None or change < SETTLED:
            break
    rest = [c for c in now.columns if c not in keys]
    best = now.groupBy(GROUP).agg(F.min(F.struct(F.round("det", 6).alias("order"), "start", *rest)).alias("best"))
    found = stored(best.select(*GROUP, *[f"best.{c}" for c in rest if c not in ("det", "factor")], F.lit(1.0).alias("factor")), "smallest")
    near = rows.join(broadcast_if_small(found), GROUP).withColumn("d", F.round(F.log1p(_scaled_distance()), 2))
    middle = near.groupBy(GROUP).agg((F.expm1(F.percentile("d", 0.5)) / MEDIAN_CHI2).alias("m"))
    return stored(found.join(middle, GROUP).withColumn("factor", F.greatest("m", F.lit(1.0))).drop("m"), "estimate")


def judge(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The columns ``carry``, ``_q`` (the counts) and ``_verdict``: ``base_failed``,
    ``distance``, ``kept``.

    The documents are counted once and stored with the columns to carry; the estimates read
    only the statistics from there.
    """
    counted = stored(_with_vector(with_counts(docs)).select(*carry, "_q", "_x", "_g"), "counted")
    vectors = counted.where(~_failed()).select("_g.*", "_x.*")
    wider = vectors.withColumns({"level": F.lit(1), "source": F.lit("")})
    rows = vectors.withColumn("level", F.lit(0)).unionByName(wider).distinct()
    found = estimate(stored(rows, "vectors"))
    xs = counted.withColumns({f"x{i}": F.col(f"_x.x{i}") for i in _DIMS})
    for kind, level in (("own", 0), ("all", 1)):
        mine = found.where(F.col("level") == level).drop("level")
        renamed = mine.select(*[F.col(c).alias(f"_{kind}_{c}") for c in mine.columns])
        on = F.col("_g.lang") == F.col(f"_{kind}_lang")
        if level == 0:
            on &= F.col("_g.source") == F.col(f"_{kind}_source")
        xs = xs.join(broadcast_if_small(renamed), on, "left")
        xs = xs.withColumn(f"_{kind}", _scaled_distance(f"_{kind}_")).drop(*renamed.columns)
    distance = F.least("_own", "_all")
    kept = ~_failed() & (F.coalesce(distance, F.lit(0.0)) <= MAX_DISTANCE)
    verdict = F.struct(_failed().alias("base_failed"), distance.alias("distance"), kept.alias("kept"))
    return xs.select(*carry, "_q", verdict.alias("_verdict"))


def report(docs: DataFrame) -> DataFrame:
    """``doc_id``, the five counts, ``base_failed``, ``kept`` and the squared ``distance``."""
    found = judge(docs, ["doc_id"])
    counts = [F.col(f"_q.{c}").alias(c) for c in COUNTS]
    return found.select("doc_id", *counts, "_verdict.base_failed", "_verdict.kept", "_verdict.distance")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text", "lang", "source")
    return judge(rows, ["row"]).where("_verdict.kept").select("row.*")
