"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

The statistics (:data:`FEATURES`) are counts over the bytes and words of the whole text, taken
in numpy from the Arrow buffers. Trees are grown level by level on binned statistics
with second-order gains, and kept as flat arrays (feature, threshold, children, value), so
that scoring walks all rows of a batch through all trees by array lookups.

Fitting sees at most ``MAX_LABELLED`` labelled rows, those with the smallest hash of the id;
only their statistics reach the driver, and the trees (some 100 KB) the tasks.

A null or empty text has all statistics zero and gets the score of such a row. Rows with a
null label are not learnt from; without labelled rows every score is 0.5. Repeated labels of
one document count each. Scoring reads nothing but ``text``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storytide.llm import textbytes
from storytide.llm.runtime import ship

MAX_LABELLED = 20_000
BINS = 64
TREES = 120
DEPTH = 5
RATE = 0.1
SHRINK = 1.0
LEAST = 20.0  # rows in a leaf
THRESHOLD = 0.3

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "lower", "digits", "symbols", "marks", "bangs",
    "bars", "high_bytes", "lines", "line_words", "distinct_words", "top_word", "distinct_pairs",
    "distinct_lines", "short_words", "long_words", "stops", "title_words", "plain_words",
)

_CLASSES = np.zeros(256, np.uint8)
_CLASSES[65:91] = 1
_CLASSES[97:123] = 2
_CLASSES[48:58] = 3
_CLASSES[list(b"#*$%&<>@^~=+_\\{}[]")] = 4
_CLASSES[list(b".,;:?'\"()-/")] = 5
_CLASSES[ord("!")] = 6
_CLASSES[ord("|")] = 7
_CLASSES[128:] = 8
_LINE_END = np.zeros(256, bool)
_LINE_END[10] = True


def _per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds."""
    done = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return np.diff(done[bounds]).astype(float)


def _repeats(row: np.ndarray, keys: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of distinct keys and the largest number of equal ones.

    Sorted as one number, the row before the upper bits of the key: a statistic may bear that
    two of some thousand words of a text rarely fall together.
    """
    room = np.uint64(max(1, int(rows - 1).bit_length()))
    both = np.sort((row.astype(np.uint64) << (np.uint64(64) - room)) | (keys >> room))
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    at = np.flatnonzero(new)
    of = (both[at] >> (np.uint64(64) - room)).astype(np.int64) if rows > 1 else np.zeros(len(at), np.int64)
    most = np.zeros(rows)
    np.maximum.at(most, of, np.diff(np.append(at, len(both))))
    return np.bincount(of, minlength=rows).astype(float), most


def _statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    kinds = _CLASSES[data]
    of_row = np.repeat(np.arange(rows) * 9, np.diff(offsets)) + kinds
    share = (np.bincount(of_row, minlength=rows * 9).reshape(rows, 9) / np.maximum(size, 1)[:, None]).T
    starts, ends, first = textbytes.words(data, offsets)
    n_words = np.diff(first).astype(float)
    row = np.repeat(np.arange(rows), np.diff(first))
    length = ends - starts
    hashes = textbytes.mix(textbytes.spans(textbytes.running(data, textbytes.LOWER_VALUES), starts, ends))
    some = np.maximum(n_words, 1)
    distinct, top = _repeats(row, hashes, rows)
    pair = textbytes.mix(hashes[:-1] + np.uint64(1)) + hashes[1:] if len(hashes) else hashes
    same = row[:-1] == row[1:]
    pairs, _ = _repeats(row[:-1][same], pair[same], rows)
    line_starts, line_ends, line_first = textbytes.words(data, offsets, _LINE_END)
    lines = np.diff(line_first).astype(float)
    line_hashes = textbytes.mix(textbytes.spans(textbytes.running(data), line_starts, line_ends))
    distinct_lines, _ = _repeats(np.repeat(np.arange(rows), np.diff(line_first)), line_hashes, rows)
    begins, last = kinds[starts], kinds[ends - 1]
    out = [
        np.log1p(size), np.log1p(n_words), _per_row(length, first) / some, share[1], share[2], share[3],
        share[4], share[5], share[6], share[7], share[8], lines / some, n_words / np.maximum(lines, 1),
        distinct / some, top / some, pairs / np.maximum(n_words - 1, 1), distinct_lines / np.maximum(lines, 1),
        _per_row(length <= 3, first) / some, _per_row(length >= 14, first) / some,
        _per_row(data[ends - 1] == ord("."), first) / some, _per_row(begins == 1, first) / some,
        _per_row(last == 2, first) / some,
    ]
    return np.stack(out, axis=1)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of :data:`FEATURES` for each text."""
    parts = [_statistics(data, offsets) for _, data, offsets in textbytes.chunks(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass
class Trees:
    """All trees in flat arrays; a leaf points to itself, so every walk has ``DEPTH`` steps."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            goes_left = x[row, self.feature[at]] <= self.threshold[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        total = self.base + self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def _best_splits(binned: np.ndarray, node: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray):
    """For each node of a level the best feature, bin and gain."""
    best = np.zeros(nodes), np.zeros(nodes, int), np.zeros(nodes, int)
    for f in range(binned.shape[1]):
        key = node * BINS + binned[:, f]
        gs = np.bincount(key, g, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
        hs = np.bincount(key, h, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
        ns = np.bincount(key, minlength=nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
        whole = gs[:, -1:] ** 2 / (hs[:, -1:] + SHRINK)
        gain = gs**2 / (hs + SHRINK) + (gs[:, -1:] - gs) ** 2 / (hs[:, -1:] - hs + SHRINK) - whole
        gain[(ns < LEAST) | (ns[:, -1:] - ns < LEAST)] = 0
        at = gain.argmax(axis=1)
        top = gain[np.arange(nodes), at]
        better = top > best[0] + 1e-9
        best[0][better], best[1][better], best[2][better] = top[better], f, at[better]
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for the log-odds of label 1."""
    nothing = np.zeros(1, int)
    if not len(y):
        return Trees(0.0, nothing, np.zeros(1), nothing, nothing, np.zeros(1), nothing)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf() -> int:
        for column, item in ((feature, 0), (threshold, 0.0), (left, len(left)), (right, len(right)), (value, 0.0)):
            column.append(item)
        return len(value) - 1

    total = np.full(len(y), base)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        level = [leaf()]
        roots.append(level[0])
        node = np.zeros(len(y), int)  # place in the level, -1 once in a leaf
        final = np.full(len(y), level[0])
        for _ in range(DEPTH):
            live = node >= 0
            gain, by, cut = _best_splits(binned[live], node[live], len(level), g[live], h[live])
            children, after = [], np.full((len(level), 2), -1)
            for k in np.flatnonzero(gain > 1e-6):
                me, pair = level[k], (leaf(), leaf())
                feature[me], threshold[me] = int(by[k]), float(edges[by[k]][cut[k]])
                left[me], right[me] = pair
                after[k] = len(children), len(children) + 1
                children += pair
            if not children:
                break
            goes_right = (binned[np.arange(len(y)), by[node]] > cut[node]).astype(int)
            node = np.where(live, after[node, goes_right], -1)
            final = np.where(node >= 0, np.array(children)[node], final)
            level = children
        gs, hs = np.bincount(final, g, len(value)), np.bincount(final, h, len(value))
        for k in np.unique(final):
            value[k] = RATE * gs[k] / (hs[k] + SHRINK)
        total += np.array(value)[final]
    arrays = (np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(roots))
    return Trees(base, *arrays)


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = MAX_LABELLED) -> DataFrame:
    """``docs`` joined with at most ``bound`` labels; the bound lets the labels be broadcast."""
    known = labels.where(F.col(label).isNotNull()).select("doc_id", F.col(label).alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(bound)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")


def train(rows: DataFrame) -> Trees:
    """Fit on rows with ``text`` and ``y`` (from :func:`training_rows`)."""
    ship(rows.sparkSession)
    schema = "doc_id long, y int, x array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array(list(statistics(b.column("text"))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y").cast(pa.int32()), x], ["doc_id", "y", "x"])

    found = rows.mapInArrow(run, schema).toPandas().sort_values(["doc_id", "y"])
    if found.empty:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit(np.stack(found["x"].to_numpy()), found["y"].to_numpy().astype(float))


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1, and ``predicted``.

    Columns of ``docs`` with one of these names are replaced, all others are kept.
    """
    spark = docs.sparkSession
    ship(spark)
    known = spark.sparkContext.broadcast(trees)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(known.value.score(statistics(pa.array(texts, pa.large_string(), from_pandas=True))))

    scored = docs.withColumn("score", F.pandas_udf(run, "double")("text"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
