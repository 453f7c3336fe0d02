"""Best-fit packing: documents into sequences of a fixed length, by the sum of squares.

Each document is tokenized, ended by ``end_id`` and cut only if it is longer than a sequence.
Full pieces are sequences of their own. The others are placed one by one in the open
sequence that leaves the sum over all gaps of the squared number of open sequences with
that gap smallest (the sum-of-squares rule). Such a sum stays small only if no gap is
left open often, so sequences tend to be filled to the end. Large pieces go first, longest
first; the small ones follow in a random order, as the rule fills best from a mixture.

Pieces are dealt to groups by a hash and each group is packed in a task of its own. What a
group leaves in sequences that are not almost full is dealt anew and packed again with the
leftovers of the other groups, in as many groups as they need, until they fit one group. Every
group tries the same few orders, whatever the number of groups. A group holds about ``GROUP_PIECES`` lengths in every round, never
a text. If a round leaves more than ``WORTH_ANOTHER`` of what it was given (say all documents
are longer than half a sequence), its sequences stay as they are: other deals of as many
pieces would fill them no better.

Null texts are empty documents: they have the end id only. Rows that share an id are
documents of their own (ties are told apart by ``row``, which counts them). An empty table
gives no pieces. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storytide.llm.runtime import ship, stored
from storytide.llm.tokens import encoder, tokenizer_path

SEQUENCE = 2048
GROUP_PIECES = 16_384
FULL_ENOUGH = 2  # tokens of gap that are not worth another round
SMALL_SHARE = 8  # pieces of up to this part of a sequence are small
WORTH_ANOTHER = 0.75  # share of the pieces that a round may leave for another one to follow
ATTEMPTS = 4  # orders tried for each group

PIECE_SCHEMA = "doc_id long, piece int, start long, length int, ids_crc32 long, ordinal long"


def _pieces(batches: Iterator[pa.RecordBatch], path: str, size: int, end_id: int) -> Iterator[pa.RecordBatch]:
    tokens = encoder(path)
    end = np.array([end_id], np.uint32)
    for batch in batches:
        names = batch.column("doc_id")
        ordinals = batch.column("ordinal")
        for row, ids, bounds in tokens.encode(batch.column("text")):
            whole = [np.concatenate([ids[bounds[k] : bounds[k + 1]], end]).astype("<u4") for k in range(len(bounds) - 1)]
            counts = np.array([-(-len(x) // size) for x in whole])
            doc = np.repeat(np.arange(len(whole)), counts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
            cut = [whole[d][p * size : (p + 1) * size] for d, p in zip(doc, piece)]
            yield pa.RecordBatch.from_arrays(
                [
                    names.slice(row, len(whole)).take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(piece * size, pa.int64()),
                    pa.array([len(x) for x in cut], pa.int32()),
                    pa.array([zlib.crc32(x.tobytes()) for x in cut], pa.int64()),
                    ordinals.slice(row, len(whole)).take(pa.array(doc)),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ordinal"],
            )


def pieces(docs: DataFrame, path: str | None = None, size: int = SEQUENCE, end_id: int = 0) -> DataFrame:
    """The pieces of every document: its ids and the end id, cut at every ``size`` ids.

    ``ordinal`` tells apart rows that share an id.
    """
    ship(docs.sparkSession)
    path = path or tokenizer_path()
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("ordinal"))
    return rows.mapInArrow(lambda batches: _pieces(batches, path, size, end_id), PIECE_SCHEMA)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item and its offset there, placing the items in the given order.

    ``open_bins[g]`` counts the open bins with gap ``g``. Moving one from gap ``g`` to
    ``g - s`` changes the sum of squares by ``2 * (open_bins[g - s] - open_bins[g]) + 2``;
    a bin that gets full and a new one change only one term.
    """
    open_bins = np.zeros(size + 1, np.int64)
    with_gap: list[list[int]] = [[] for _ in range(size + 1)]
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    never = np.iinfo(np.int64).max
    made = 0
    for i, s in enumerate(lengths):
        now = open_bins[s:]
        change = 2 * (open_bins[: size - s + 1] - now) + 2
        change[0] -= 1
        change[now == 0] = never
        change[-1] = 2 * open_bins[size - s] + 1 if s < size else 0
        gap = s + int(change.argmin())
        if gap == size:
            where, made = made, made + 1
        else:
            where = with_gap[gap].pop()
            open_bins[gap] -= 1
        bins[i], offsets[i] = where, size - gap
        if gap > s:
            open_bins[gap - s] += 1
            with_gap[gap - s].append(where)
    return bins, offsets


def _pack_group(frame: pd.DataFrame, *, size: int, number: int) -> pd.DataFrame:
    frame = frame.sort_values(["doc_id", "piece", "ordinal"], ignore_index=True)
    lengths = frame["length"].to_numpy().astype(np.int64)
    large = lengths > size // SMALL_SHARE
    best = None
    for attempt in range(ATTEMPTS):
        shuffled = np.random.default_rng([number, attempt]).permutation(len(lengths))
        order = shuffled[np.argsort(-np.where(large, lengths, 0)[shuffled], kind="stable")]
        bins, offsets = sum_of_squares(lengths[order], size)
        if best is None or bins.max() < best[1].max():
            best = order, bins, offsets
        if best[1].max() + 1 == -(-lengths.sum() // size):
            break
    order, bins, offsets = best
    filled = np.bincount(bins, weights=lengths[order]).astype(np.int64)
    return frame.iloc[order].assign(bin=bins, offset=offsets, gap=size - filled[bins])


def pack(parts: DataFrame, size: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``parts`` (from :func:`pieces`, stored) with ``sequence_id`` and ``offset``.

    Each round packs every group and keeps the sequences that are full enough; the pieces
    of the rest enter the next round, dealt by another hash to groups of the same size. The last
    round is one group of at most ``group_pieces`` or ``GROUP_PIECES`` pieces, or the
    first one that leaves too many.
    """
    key = F.xxhash64("doc_id", "piece", "ordinal")
    full = F.col("length") == size
    one = F.lit(0).cast("long")
    columns = [*parts.columns, "offset", "sequence_id"]
    done = [parts.where(full).withColumns({"offset": one, "sequence_id": F.struct(F.lit(-1).alias("round"), key.alias("group"), one.alias("bin"))})]
    rest = parts.where(~full)
    left = rest.count()
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in parts.schema)}, grp long, bin long, offset long, gap long"
    number = 0
    groups = max(1, -(-left // group_pieces))
    while True:
        deal = F.xxhash64("doc_id", "piece", "ordinal", F.lit(number))
        grouped = rest.withColumn("grp", F.pmod(deal, F.lit(groups)))
        run = partial(_pack_group, size=size, number=number)
        packed = stored(grouped.groupBy("grp").applyInPandas(lambda f: run(f), schema), f"packed{number}")
        named = packed.withColumn("sequence_id", F.struct(F.lit(number).alias("round"), F.col("grp").alias("group"), "bin"))
        rest = packed.where(F.col("gap") > FULL_ENOUGH).select(parts.columns)
        given, left = left, 0 if groups == 1 else rest.count()
        last = left <= max(group_pieces, GROUP_PIECES)
        if groups == 1 or (not last and left > WORTH_ANOTHER * given):
            done.append(named.select(columns))
            break
        done.append(named.where(F.col("gap") <= FULL_ENOUGH).select(columns))
        groups = 1 if last else -(-left // group_pieces)
        number += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    sequence = F.xxhash64("sequence_id.round", "sequence_id.group", "sequence_id.bin")
    return out.withColumn("sequence_id", sequence)


def best_fit(docs: DataFrame, path: str | None = None, size: int = SEQUENCE, end_id: int = 0) -> DataFrame:
    """One row for each piece of every document: where it lies in which sequence.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. The documents are
    tokenized once; only the narrow rows of pieces are stored and shuffled.
    """
    parts = stored(pieces(docs, path, size, end_id), "pieces")
    return pack(parts, size).drop("ordinal").withColumn("length", F.col("length").cast("long"))
