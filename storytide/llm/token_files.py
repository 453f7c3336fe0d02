"""Token-ID files: every id in the fewest bits that the vocabulary needs.

A set of token files is a Parquet dataset whose rows are *blocks*. A block holds whole
documents in ascending id order, at least ``BLOCK_IDS`` ids unless it is the last of its
shard, and carries

* ``shard``, ``block``: its place; shards follow one another in document order,
* ``offset``: ids of the same shard before it, ``n_ids``, ``bits`` per id,
* ``doc_ids``, ``doc_starts``: its documents and where each begins inside the block,
* ``payload``: the ids, least significant bit first, without gaps.

As the width is fixed, id ``i`` of a block lies at bit ``i * bits``: :func:`unpack` reads
any range of a payload without what stands before it.

Null texts are empty documents (their end id only); rows with a null id come first; rows
that share an id stay together, one document each, ordered by a hash of the text. An empty
table gives files without blocks. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storytide.llm.runtime import partitions, ship
from storytide.llm.tokens import encoder, tokenizer_path

BLOCK_IDS = 1 << 16

BLOCK_SCHEMA = (
    "shard int, block int, offset long, n_ids long, bits int, "
    "doc_ids array<long>, doc_starts array<long>, payload binary"
)


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, least significant first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    as_bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(as_bits[:, :bits], bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """The ``count`` ids from ``start`` on; reads only the bytes that hold them."""
    first = start * bits // 8
    last = -(-(start + count) * bits // 8)
    raw = np.frombuffer(payload, np.uint8, last - first, first)
    as_bits = np.unpackbits(raw, bitorder="little")[start * bits - first * 8 :][: count * bits]
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = as_bits.reshape(count, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def _blocks(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    tokens = encoder(path)
    shard = TaskContext.get().partitionId()
    block = offset = 0
    doc_ids: list[int | None] = []
    parts: list[np.ndarray] = []
    starts: list[int] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal block, offset, held
        ids = np.concatenate(parts)
        rows = [[shard], [block], [offset], [held], [tokens.bits], [list(doc_ids)], [list(starts)], [pack(ids, tokens.bits)]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        names = ["shard", "block", "offset", "n_ids", "bits", "doc_ids", "doc_starts", "payload"]
        out = pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names)
        block, offset, held = block + 1, offset + held, 0
        doc_ids.clear(), parts.clear(), starts.clear()
        return out

    end = np.array([end_id], np.uint32)
    for batch in batches:
        names = batch.column("doc_id").to_pylist()
        for row, ids, bounds in tokens.encode(batch.column("text")):
            for k in range(len(bounds) - 1):
                doc_ids.append(names[row + k])
                starts.append(held)
                parts += [ids[bounds[k] : bounds[k + 1]], end]
                held += int(bounds[k + 1] - bounds[k]) + 1
                if held >= BLOCK_IDS:
                    yield flush()
    if held:
        yield flush()


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 1) -> None:
    """Tokenize ``docs`` and write them to ``folder`` in ascending id order.

    Documents are dealt to shards by ranges of the id; within a shard one task encodes a
    few megabytes of text at a time and holds one block.
    """
    spark = docs.sparkSession
    ship(spark)
    path = path or tokenizer_path()
    narrow = docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
    ordered = narrow.repartitionByRange(partitions(spark), "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    blocks = ordered.drop("_tie").mapInArrow(lambda batches: _blocks(batches, path, end_id), BLOCK_SCHEMA)
    blocks.write.option("compression", "uncompressed").parquet(folder)


def _documents(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["payload"], row["bits"], 0, row["n_ids"])
            starts = row["doc_starts"]
            ends = [*starts[1:], row["n_ids"]]
            pieces = [ids[a:b] for a, b in zip(starts, ends)]
            out = {
                "shard": pa.array([row["shard"]] * len(starts), pa.int32()),
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "at": pa.array([row["offset"] + a for a in starts], pa.int64()),
                "n_tokens": pa.array([len(x) for x in pieces], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in pieces], pa.int64()),
            }
            if with_ids:
                out["ids"] = pa.array([x.astype(np.int32) for x in pieces], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """The documents of a set of token files: ``doc_id``, ``start``, ``n_tokens``,
    ``ids_crc32`` and, if wanted, the ``ids``.

    ``start`` counts the ids of all documents before. Only one sum for each shard, of which
    there are as many as shuffle partitions, passes through the driver.
    """
    ship(spark)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(folder)
    sums = {r.shard: r.n for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    base, before = [], 0
    for shard in sorted(sums):
        base.append((shard, before))
        before += sums[shard]
    schema = "shard int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    docs = blocks.mapInArrow(lambda batches: _documents(batches, with_ids), schema)
    bases = F.broadcast(spark.createDataFrame(base, "shard int, base long"))
    out = docs.join(bases, "shard").withColumn("start", F.col("base") + F.col("at"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)
