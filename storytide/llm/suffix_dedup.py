"""Exact substring dedup: remove what a hundred bytes long has been seen before.

Every byte inside a string of ``LENGTH`` bytes that also starts earlier (in a document with a
smaller id, or earlier in the same one) is removed. Strings are judged on the input, overlaps
count, and no string crosses documents.

1. *Anchors.* In each window of ``LENGTH`` bytes the ``GRAM`` bytes with the smallest hash are its
   anchor, so equal strings have equal anchors, and about one position in thirty is one. The
   stretch of an anchor joins all windows it stands for. A task sends anchors to buckets by their
   hash, each distinct stretch once; repeats inside the task are settled there.
2. *Buckets.* A stretch that is equal to an earlier one is removed whole. An anchor with only one
   stretch needs no more work. Only where several stretches share an anchor the first of each
   is fetched from its text.
3. *Suffix arrays.* Each shard of such stretches sorts its suffixes by Larsson-Sadakane refinement:
   ranks of ``LETTER`` bytes, doubled until they cover ``LENGTH`` bytes; only groups of equal
   suffixes are sorted again. The common prefixes of neighbours are counted in Kasai's order of
   places, in which each byte of a run of pairs is compared once. Of windows with ``LENGTH``
   bytes in common all but the first are removed.
4. *Merging.* An anchor with more than ``SPLIT`` stretches is dealt to several shards; their sorted
   windows are merged by binary search of each run in those merged before.

In 3 bytes are compared. Whole stretches (2) and windows of different shards (4) are equal if 128 bits
of two different hashes are.

Null texts are empty. Repeated rows (same id and text) are one document and get the same
result each. Rows with one id and different texts are ordered by a hash of the text; a null id
comes after all others. An empty table gives an empty result; other columns are carried
along. Cuts may fall inside a character: :func:`remove_repeats` drops what is left of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storytide.llm import textbytes
from storytide.llm.runtime import only, partitions, ship, stored, with_key

LENGTH = 100
GRAM = 32
LETTER = 8
SPLIT = 512
SORT_BYTES = 1 << 18  # of stretches in one suffix array
SLICE_ANCHORS = 1_000_000
BUCKETS = 4  # for each shuffle partition

_PLACES = LENGTH - GRAM + 1
BLOB_SCHEMA = "bucket int, a binary, c binary, doc binary, at binary, before binary, windows binary, done binary"
MARK_SCHEMA = "kind int, doc long, start int, stop int, a long, part int, b long"


# ---------------------------------------------------------------- anchors


def _sliding(x: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """``pick`` over x[p : p + width] for each p; what lies beyond the end is left out."""
    out, span = x.copy(), 1
    while span < width:
        step = min(span, width - span)
        out[: len(out) - step] = pick(out[: len(out) - step], out[step:])
        span += step
    return out


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places, hashes, first and last window of the anchors, and hashes of their stretches."""
    none = np.zeros(0, np.int64)
    size = np.diff(offsets)
    if len(data) < LENGTH or size.max() < LENGTH:
        return none, none.astype(np.uint64), none, none, none.astype(np.uint64)
    sums = textbytes.running(data)
    places = np.arange(len(data) - GRAM + 1)
    hashes = textbytes.mix(textbytes.spans(sums, places, places + GRAM))
    order = np.maximum((hashes >> np.uint64(32)).astype(np.uint32), 1)
    lowest = _sliding(order, _PLACES, np.minimum)
    change = np.zeros(len(data) + 1, np.int8)
    change[offsets[:-1][size >= LENGTH]] += 1
    change[(offsets[1:] - LENGTH + 1)[size >= LENGTH]] -= 1
    lowest[np.cumsum(change, dtype=np.int8)[: len(lowest)] == 0] = 0
    at = np.flatnonzero(_sliding(lowest[::-1], _PLACES, np.maximum)[::-1] == order)
    # windows with one minimum form a run; the run of an anchor begins where it is in reach
    starts = np.flatnonzero(np.concatenate(([True], lowest[1:] != lowest[:-1])))
    ends = np.append(starts[1:], len(lowest))
    run = np.searchsorted(starts, at, side="right") - 1
    while len(wrong := np.flatnonzero(lowest[starts[run]] != order[at])):
        run[wrong] -= 1
    first = np.maximum(starts[run], at - _PLACES + 1)
    last = np.minimum(ends[run] - 1, at)
    shape = (at - first) * LENGTH + (last - first)
    stretch = textbytes.mix(textbytes.hashed(data, first, last + LENGTH) + textbytes.mix(shape.astype(np.uint64)))
    return at, hashes[at], first, last, stretch


def _merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping or touching intervals of a document as one."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    if not len(doc):
        return doc, start, stop
    fresh = np.append(True, doc[1:] != doc[:-1])
    group = np.cumsum(fresh) - 1
    reach = np.maximum.accumulate(stop + group * (np.int64(1) << 32)) - group * (np.int64(1) << 32)
    begins = fresh.copy()
    begins[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(begins)
    return doc[at], start[at], reach[np.append(at[1:], len(doc)) - 1]


def _first_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort order by the keys, and where a new value of all but the last two keys begins."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys[:-2]:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    return order, new


def _send(parts: list[tuple[np.ndarray, ...]], buckets: int) -> pa.RecordBatch:
    """One row for each bucket with the distinct stretches of a slice, and in one of them the
    intervals that the slice settles by itself."""
    doc, at, a, before, windows, c = (np.concatenate(x) for x in zip(*parts))
    order, new = _first_of(a, c, doc, at)
    group = np.cumsum(new) - 1
    lead = order[new][group]
    again = ~new & ((doc[order] != doc[lead]) | (at[order] != at[lead]))
    late = order[again]
    begin = at[late] - before[late]
    done = _merged(doc[late], begin, begin + windows[late] - 1 + LENGTH)
    kept = order[new]
    bucket = (a[kept] % np.uint64(buckets)).astype(np.int32)
    kept = kept[np.argsort(bucket, kind="stable")]
    bucket = np.sort(bucket)
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    rows: dict[str, list] = {name: [] for name in ("bucket", "a", "c", "doc", "at", "before", "windows", "done")}
    for i, (x, y) in enumerate(zip(cuts, np.append(cuts[1:], len(kept)))):
        k = kept[x:y]
        rows["bucket"].append(int(bucket[x]))
        for name, values, kind in (
            ("a", a, np.uint64), ("c", c, np.uint64), ("doc", doc, np.int64),
            ("at", at, np.int32), ("before", before, np.uint8), ("windows", windows, np.uint8),
        ):
            rows[name].append(textbytes.planes(values[k].astype(kind)))
        settled = b"".join(textbytes.planes(v.astype(np.int64)) for v in done) if i == 0 else b""
        rows["done"].append(settled)
    kinds = [pa.int32(), *[pa.binary()] * 7]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], list(rows))


def _find_anchors(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    parts, held = [], 0
    for batch in batches:
        ids = batch.column("doc").to_numpy()
        for row, data, offsets in textbytes.chunks(batch.column("text")):
            at, a, first, last, c = anchors(data, offsets)
            if not len(at):
                continue
            doc = np.searchsorted(offsets, at, side="right") - 1
            parts.append((ids[row + doc], at - offsets[doc], a, at - first, last - first + 1, c))
            held += len(at)
            if held >= SLICE_ANCHORS:
                yield _send(parts, buckets)
                parts, held = [], 0
    if parts:
        yield _send(parts, buckets)


def _marks(kind, doc, start, stop, a=None, part=None, b=None) -> pa.Table:
    n = len(doc)
    zero = np.zeros(n, np.int64)
    return pa.table(
        {
            "kind": pa.array(np.full(n, kind, np.int32)),
            "doc": pa.array(doc.astype(np.int64)),
            "start": pa.array(start.astype(np.int32)),
            "stop": pa.array(stop.astype(np.int32)),
            "a": pa.array(zero if a is None else a.view(np.int64)),
            "part": pa.array((zero if part is None else part).astype(np.int32)),
            "b": pa.array(zero if b is None else b.view(np.int64)),
        }
    )


def _settle_bucket(rows: pa.Table) -> pa.Table:
    """Kind 0: intervals to remove. Kind 1: stretches whose text is needed."""
    kinds = {"a": np.uint64, "c": np.uint64, "doc": np.int64, "at": np.int32, "before": np.uint8, "windows": np.uint8}
    columns = {n: np.concatenate([textbytes.numbers(x.as_py(), k) for x in rows.column(n)]) for n, k in kinds.items()}
    a, c, doc, at = (columns[n] for n in ("a", "c", "doc", "at"))
    start = at.astype(np.int64) - columns["before"]
    stop = start + columns["windows"] - 1 + LENGTH
    out = []
    for settled in rows.column("done"):
        if len(settled.as_py()):
            three = np.frombuffer(settled.as_py(), np.uint8).reshape(3, -1)
            out.append(_marks(0, *[textbytes.numbers(x.tobytes(), np.int64) for x in three]))
    order, new = _first_of(a, c, doc, at)
    lead = order[new][np.cumsum(new) - 1]
    late = order[~new & ((doc[order] != doc[lead]) | (at[order] != at[lead]))]
    out.append(_marks(0, *_merged(doc[late], start[late], stop[late])))
    heads = order[new]
    key = a[heads]
    same = np.zeros(len(heads), bool)
    same[1:] = key[1:] == key[:-1]
    group = np.cumsum(~same) - 1
    size = np.bincount(group)[group]
    edge, size = heads[size > 1], size[size > 1]
    shares = -(-size // SPLIT)
    part = np.where(shares > 1, textbytes.mix(doc[edge].view(np.uint64)) % shares.astype(np.uint64) + np.uint64(1), np.uint64(0))
    out.append(_marks(1, doc[edge], start[edge], stop[edge], a[edge], part.astype(np.int64)))
    return pa.concat_tables(out)


# ---------------------------------------------------------------- stretches


def _cut_out(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the asked stretches, with the shard that they go to."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for doc, packed, asked in zip(*(batch.column(n) for n in ("doc", "text", "asked"))):
            text = unpack.decompress(packed.as_py())
            wanted = asked.values.flatten()
            start, stop, a, part = (x.to_numpy() for x in wanted)
            shard = textbytes.mix(a.view(np.uint64) + part.astype(np.uint64)) % np.uint64(shards)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard.astype(np.int32)),
                    pa.array(np.full(len(start), doc.as_py(), np.int64)),
                    pa.array(start),
                    pa.array(a),
                    pa.array(part),
                    pa.array([text[x:y] for x, y in zip(start, stop)], pa.binary()),
                ],
                ["shard", "doc", "start", "a", "part", "bytes"],
            )


def suffix_order(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all suffixes by their first ``LENGTH`` bytes, and by the length refined before.

    The first ranks are those of ``LETTER`` bytes. Each round sorts the suffixes of every group that is
    not settled by the rank of what follows, which doubles the length. A group's rank is the
    place of its first suffix in the order, so the other groups keep theirs.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(LETTER, np.uint8)])
    letters = np.lib.stride_tricks.sliding_window_view(padded, LETTER)[:n]
    letters = np.ascontiguousarray(letters).view(">u8").ravel().astype(np.uint64)
    order = np.argsort(letters)
    ordered = letters[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[:n]
    rank = np.full(n + LENGTH, -1, np.int64)  # behind the end: before all others
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h, before = LETTER, rank
    while h < LENGTH:
        step, before = min(h, LENGTH - h), rank.copy()
        alone = new & np.append(new[1:], True)
        todo = np.flatnonzero(~alone)
        if len(todo):
            suffix = order[todo]
            group, follows = before[suffix], before[suffix + step]
            again = np.lexsort((follows, group))
            suffix, group, follows = suffix[again], group[again], follows[again]
            order[todo] = suffix
            changed = np.append(True, (group[1:] != group[:-1]) | (follows[1:] != follows[:-1]))
            new[todo] = changed
            rank[suffix] = np.maximum.accumulate(np.where(changed, todo, 0))
        h += step
    return rank[:n], before[:n]


def common_prefixes(data: np.ndarray, place: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Bytes (at most ``LENGTH``) that the suffixes at ``place`` and ``other`` have in common.

    In Kasai's order of places: while both sides move on by one byte, the prefix that is left gets shorter
    by one byte, so that only the bytes of a whole run are compared, each once.
    """
    out = np.zeros(len(place), np.int64)
    if not len(place):
        return out
    heads = np.flatnonzero(np.append(True, (place[1:] != place[:-1] + 1) | (other[1:] != other[:-1] + 1)))
    sizes = np.diff(np.append(heads, len(place)))
    first = 0
    while first < len(heads):  # some of the runs at a time
        total = np.cumsum(sizes[first : first + (1 << 12)] + LENGTH - 1)
        some = heads[first : first + max(1, int(np.searchsorted(total, SORT_BYTES // 2)))]
        width = sizes[first : first + len(some)] + LENGTH - 1
        base = np.cumsum(width) - width
        inner = np.arange(int(width.sum())) - np.repeat(base, width)
        differ = data[np.repeat(place[some], width) + inner] != data[np.repeat(other[some], width) + inner]
        at = np.arange(len(inner))
        end = np.repeat(base + width, width)
        until = np.minimum(np.minimum.accumulate(np.where(differ, at, len(at))[::-1])[::-1], end)
        windows = inner < np.repeat(width - LENGTH + 1, width)
        low = some[0]
        out[low : low + int(windows.sum())] = np.minimum(until - at, LENGTH)[windows]
        first += len(some)
    return out


def _sort_shard(rows: pa.Table) -> pa.Table:
    """Kind 0: intervals to remove. Kind 2: first windows of anchors dealt to several shards,
    ``start`` being the window and ``a`` a hash of its bytes."""
    parts = rows.column("bytes").combine_chunks()
    doc, start, a, part = (rows.column(n).to_numpy() for n in ("doc", "start", "a", "part"))
    out = []
    order = np.argsort(a, kind="stable")
    sizes = np.asarray(pa.compute.binary_length(parts))[order]
    groups = np.flatnonzero(np.append(True, a[order][1:] != a[order][:-1])) if len(order) else []
    total = np.concatenate(([0], np.cumsum(sizes)))
    lo = 0
    bounds = [*groups, len(order)]
    for x, y in zip(bounds, bounds[1:]):  # whole anchors, as many as fit
        if total[y] - total[lo] >= SORT_BYTES or y == len(order):
            some = order[lo:y]
            out.append(_repeats(parts.take(pa.array(some)), doc[some], start[some].astype(np.int64), part[some]))
            lo = y
    return pa.concat_tables(out) if out else _marks(0, *[np.zeros(0, np.int64)] * 3)


def _repeats(parts: pa.Array, doc: np.ndarray, start: np.ndarray, part: np.ndarray) -> pa.Table:
    (_, data, offsets), *more = textbytes.chunks(parts, limit=1 << 62)
    assert not more
    windows = np.diff(offsets) - LENGTH + 1
    of = np.repeat(np.arange(len(windows)), windows)
    inner = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    valid, at = offsets[of] + inner, start[of] + inner
    ranks, shorter = suffix_order(data)
    order, new = _first_of(ranks[valid], doc[of], at)
    # neighbours in the suffix array that the last round but one did not tell apart
    above = np.append(0, order[:-1])
    near = np.flatnonzero(np.append(False, shorter[valid[order[1:]]] == shorter[valid[order[:-1]]]))
    near = near[np.argsort(order[near], kind="stable")]
    prefix = np.zeros(len(order), np.int64)
    prefix[near] = common_prefixes(data, valid[order[near]], valid[above[near]])
    new = prefix < LENGTH
    lead = order[new][np.cumsum(new) - 1]
    late = order[~new & ((doc[of][order] != doc[of][lead]) | (at[order] != at[lead]))]
    out = [_marks(0, *_merged(doc[of][late], at[late], at[late] + LENGTH))]
    split = order[new & (part[of][order] > 0)]
    if len(split):
        begin, end = valid[split], valid[split] + LENGTH
        keys = textbytes.mix(textbytes.spans(textbytes.running(data), begin, end))
        second = textbytes.hashed(data, begin, end)
        out.append(_marks(2, doc[of][split], at[split], at[split] + LENGTH, keys, part[of][split].astype(np.int64), second))
    return pa.concat_tables(out)


def _merge_runs(rows: pa.Table) -> pa.Table:
    """Windows that an earlier place of another shard has too.

    Runs are merged one by one: each window is looked up by binary search among those merged so
    far, of which the first place is kept.
    """
    part, a, b, doc, at = (rows.column(n).to_numpy() for n in ("part", "a", "b", "doc", "start"))
    _, key = np.unique(np.stack([a, b], axis=1), axis=0, return_inverse=True)
    key = key.ravel()
    late = np.zeros(len(key), bool)
    merged = np.zeros(0, np.int64)
    for p in np.unique(part):
        run = np.flatnonzero(part == p)
        run = run[np.lexsort((at[run], doc[run], key[run]))]
        again = np.append(False, key[run[1:]] == key[run[:-1]])
        lead = run[~again][np.cumsum(~again) - 1]
        late[run] = again & ((doc[run] != doc[lead]) | (at[run] != at[lead]))
        run = run[~again]
        place = np.searchsorted(key[merged], key[run])
        known = place < len(merged)
        known[known] = key[merged[place[known]]] == key[run[known]]
        old, new = merged[place[known]], run[known]
        earlier = (doc[new] < doc[old]) | ((doc[new] == doc[old]) & (at[new] < at[old]))
        other = (doc[new] != doc[old]) | (at[new] != at[old])
        late[np.where(earlier, old, new)[other]] = True
        merged[place[known]] = np.where(earlier, new, old)
        merged = np.insert(merged, place[~known], run[~known])
    return _marks(0, *_merged(doc[late], at[late].astype(np.int64), at[late].astype(np.int64) + LENGTH))


# ---------------------------------------------------------------- jobs


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """``doc, start, stop``: byte intervals to remove, not yet merged between anchors."""
    spark = keyed.sparkSession
    ship(spark)
    buckets = BUCKETS * partitions(spark)
    texts = keyed.select("doc", "text")
    blobs = texts.mapInArrow(lambda x: _find_anchors(x, buckets), BLOB_SCHEMA)
    marks = stored(blobs.groupBy("bucket").applyInArrow(lambda t: _settle_bucket(t), MARK_SCHEMA), "anchors")
    asked = marks.where("kind = 1").groupBy("doc").agg(F.collect_list(F.struct("start", "stop", "a", "part")).alias("asked"))
    # only texts with a stretch that must be compared are moved
    needed = only(texts, marks.where("kind = 1").select("doc").distinct(), "doc")
    squeezed = needed.mapInArrow(textbytes.squeezed, "doc long, text binary").dropDuplicates(["doc"])
    wanted = squeezed.join(asked, "doc")
    shape = "shard int, doc long, start int, a long, part int, bytes binary"
    stretches = wanted.mapInArrow(lambda x: _cut_out(x, buckets), shape)
    found = stored(stretches.groupBy("shard").applyInArrow(lambda t: _sort_shard(t), MARK_SCHEMA), "stretches")
    runs = found.where("kind = 2").withColumn("_range", F.pmod("a", F.lit(buckets)))
    merged = runs.groupBy("_range").applyInArrow(lambda t: _merge_runs(t), MARK_SCHEMA)
    spans = marks.where("kind = 0").union(found.where("kind = 0")).union(merged)
    return spans.select("doc", "start", "stop")


def _with_spans(docs: DataFrame) -> DataFrame:
    """``row`` (the columns of ``docs`` but the text), the text squeezed, and ``spans``, the intervals of each document."""
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    keyed = with_key(docs.select(F.struct(*columns).alias("row"), "doc_id", "text"))
    found = repeated_spans(keyed).groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    rows = keyed.select("row", "doc", "text")
    schema = T.StructType([rows.schema["row"], T.StructField("doc", T.LongType()), T.StructField("text", T.BinaryType())])
    return rows.mapInArrow(textbytes.squeezed, schema).join(found, "doc", "left").drop("doc")


def _kept(packed: bytes | None, spans, unpack) -> tuple[int, list[bytes], int]:
    """Bytes of the text, what is left of them, and the number of maximal removed runs."""
    text = unpack.decompress(packed) if packed is not None else b""
    if spans is None:
        return len(text), [text], 0
    start, stop = (x.to_numpy().astype(np.int64) for x in spans.flatten())
    _, start, stop = _merged(np.zeros(len(start), np.int64), start, stop)
    edges = [0, *np.stack([start, stop], axis=1).ravel().tolist(), len(text)]
    return len(text), [text[x:y] for x, y in zip(edges[::2], edges[1::2])], len(start)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for packed, spans in zip(batch.column("text"), batch.column("spans")):
            size, parts, n = _kept(packed.as_py(), spans.values, unpack)
            kept = b"".join(parts)
            rows.append((size, size - len(kept), n, hashlib.sha256(kept).hexdigest()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array(x, k) for x, k in zip(zip(*rows), kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("row").field("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def report(docs: DataFrame) -> DataFrame:
    """For every document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    spans = _with_spans(docs.select("doc_id", "text"))
    return spans.mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated strings taken out of ``text``; null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = []
            for packed, spans in zip(batch.column("text"), batch.column("spans")):
                parts = _kept(packed.as_py(), spans.values, unpack)[1]
                whole = "".join(p.decode("utf-8", "ignore") for p in parts)
                texts.append(None if packed.as_py() is None else whole)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    spans = _with_spans(docs)
    cleaned = spans.mapInArrow(run, T.StructType([spans.schema["row"], T.StructField("text", T.StringType())]))
    return cleaned.select(*["text" if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
