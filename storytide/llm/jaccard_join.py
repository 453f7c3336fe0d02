"""N-gram Jaccard join: all pairs of texts whose shingle sets overlap enough, as components.

A text is the set of its five-word shingles (A-Z in lower case; a shorter text is one shingle).
One minus the Jaccard similarity is a metric; two texts link at a distance of ``RADIUS`` or less.

1. *Pivots.* Shingles have one order in all texts: by hash, the very frequent ones last. Two
   texts that link share a shingle of their prefixes (the first quarter of each set and one more),
   so all texts with one shingle in the prefix go to the region of a pivot, the first text that
   has it. A text lies in the region of each pivot that may be near it, and both texts of a
   link share a region. The pivots of frequent shingles are known to every task (at most
   ``MAX_FREQUENT``), so their texts are never gathered by shingle.
   The prefix is sent with another seventh of the set (``EXTRA``): a text that links with any
   other shares a tenth of its shingles there, so texts that share less (a passage that many texts
   quote) are dropped by counting, before any text is moved.
2. *Regions.* Inside a region a text whose shingles are too rare there is dropped. The distance
   from the pivot is exact; what is within the radius is linked to it. Then the texts outside are
   pivots in turn, the smallest groups first, for the texts of other groups whose distance from
   the first pivot differs by the radius at most (the triangle inequality), until one group
   is left. No pair is sent anywhere: a region gives the links that join its groups.
3. *Large regions* (above ``REGION`` texts or ``REGION_SHINGLES``) are dealt in parts: first the distances from the pivot, then
   rings of that distance. A text outside the radius joins the blocks of its own ring and the
   two beside it; texts within the radius count as one group there.

Links become components by alternating stars. Texts with equal sets are joined before all that.

Null texts and texts without a word have no shingles, link with nothing and are components of
their own. Repeated rows (same id and text) count as one text and each get a row; a null id
comes last; ids that are not whole numbers are numbered first. An empty table gives an empty result. Columns
other than ``doc_id`` and ``text`` are carried by :func:`keep_first`, whatever their names, and never
read. Shingles are compared by 48 bits of a hash of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storytide.llm import textbytes
from storytide.llm.components import components
from storytide.llm.runtime import only, partitions, ship, stored, whole_rows, with_key

WORDS = 5
NEED, OF = 3, 4  # similarity of at least 3/4
RADIUS = 1 - NEED / OF
FREQUENT = 64  # texts with a shingle from which it counts as frequent
LOCAL = 3  # of them in one slice of a task, to be noticed there
MAX_FREQUENT = 1 << 17
REGION = 1024  # texts, and
REGION_SHINGLES = 500_000  # shingles that a task holds of a region
EXTRA = 15  # hundredths of a set sent beside its prefix
SLICE = 1_000_000  # shingles
BUCKETS = 4  # for each shuffle partition

_HASH = np.uint64(16)  # bits of the row of a chunk; the other 48 are the shingle's
_ROWS = 1 << 16


# ---------------------------------------------------------------- sets


def _chunk_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = textbytes.words(data, offsets)
    words = textbytes.hashed(data, starts, ends, textbytes.LOWER_VALUES)
    n = np.diff(first)
    row = np.arange(len(n), dtype=np.uint64)
    # windows over the whole chunk; those that reach into the next text are dropped
    whole = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for j in range(WORDS):
        whole = textbytes.mix(whole * np.uint64(3) + words[j : j + len(whole)] + np.uint64(j))
    of = np.repeat(row, np.maximum(n - WORDS + 1, 0))
    at = np.arange(len(of)) - np.repeat(np.cumsum(np.maximum(n - WORDS + 1, 0)) - np.maximum(n - WORDS + 1, 0), np.maximum(n - WORDS + 1, 0))
    values = whole[np.repeat(first[:-1], np.maximum(n - WORDS + 1, 0)) + at]
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        tail = np.zeros(len(short), np.uint64)
        for j in range(WORDS - 1):
            has = n[short] > j
            tail[has] = textbytes.mix(tail[has] * np.uint64(3) + words[first[short[has]] + j] + np.uint64(j))
        values = np.concatenate([values, textbytes.mix(tail + n[short].astype(np.uint64))])
        of = np.concatenate([of, short.astype(np.uint64)])
    both = np.unique((of << np.uint64(48)) | (values >> _HASH))
    return np.bincount((both >> np.uint64(48)).astype(np.int64), minlength=len(n)), both & np.uint64((1 << 48) - 1)


def sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, sizes of the sets, all shingle hashes, sorted in each set)."""
    for row, data, offsets in textbytes.chunks(texts):
        for lo in range(0, len(offsets) - 1, _ROWS):
            part = offsets[lo : lo + _ROWS + 1]
            yield row + lo, *_chunk_sets(data[part[0] : part[-1]], part - part[0])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, sizes, hashes) of some millions of shingles at a time."""
    held, parts = 0, []
    for batch in batches:
        ids = batch.column("doc").to_numpy()
        for row, sizes, hashes in sets(batch.column("text")):
            parts.append((ids[row : row + len(sizes)], sizes, hashes))
            held += len(hashes)
            if held >= SLICE:
                yield tuple(np.concatenate(x) for x in zip(*parts))
                held, parts = 0, []
    if parts:
        yield tuple(np.concatenate(x) for x in zip(*parts))


def _count_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for doc, sizes, hashes in _slices(batches):
        order = np.argsort(hashes, kind="stable")
        ordered, owner = hashes[order], np.repeat(doc, sizes)[order]
        at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
        counts = np.diff(np.append(at, len(ordered)))
        many = np.flatnonzero(counts >= LOCAL)
        first = np.minimum.reduceat(owner, at)[many] if len(at) else owner
        yield pa.RecordBatch.from_arrays(
            [pa.array(ordered[at[many]].astype(np.int64)), pa.array(counts[many]), pa.array(first)], ["h", "n", "pivot"]
        )


def frequent_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and the first text of each.

    Only the order of shingles depends on them, not the result; a shingle counts where a
    slice of a task has it ``LOCAL`` times.
    """
    found = texts.mapInArrow(_count_frequent, "h long, n long, pivot long")
    total = found.groupBy("h").agg(F.sum("n").alias("n"), F.min("pivot").alias("pivot")).where(F.col("n") >= FREQUENT)
    top = total.orderBy(F.desc("n"), "h").limit(MAX_FREQUENT).toArrow().sort_by("h")
    return top.column("h").to_numpy().astype(np.uint64), top.column("pivot").to_numpy()


# ---------------------------------------------------------------- regions

BLOB_SCHEMA = "bucket int, h binary, doc binary, near binary, sizes binary"
ROW_SCHEMA = "kind int, x long, y long, sig long"


def _send_prefixes(batches: Iterator[pa.RecordBatch], hot: np.ndarray, pivots: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Prefix shingles by bucket; in one of them the sizes and the pairs with known pivots."""
    for doc, sizes, hashes in _slices(batches):
        owner = np.repeat(np.arange(len(doc)), sizes)
        place = np.searchsorted(hot, hashes)
        place[place == len(hot)] = 0
        known = hot[place] == hashes if len(hot) else np.zeros(len(hashes), bool)
        order = np.argsort(owner * 2 + known, kind="stable")
        rank = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        # two prefixes that are longer by m - 1 share m shingles
        prefix = np.where(sizes > 0, sizes - (NEED * sizes + OF - 1) // OF + 1, 0)
        length = prefix + np.maximum(EXTRA * sizes // 100 - 1, 0)
        base = np.zeros(len(owner), bool)
        base[order] = rank < prefix[owner]
        chosen = order[rank < length[owner]]
        sums = np.zeros(len(doc), np.uint64)
        some = np.flatnonzero(sizes)
        if len(some):
            sums[some] = np.add.reduceat(textbytes.mix(hashes), (np.cumsum(sizes) - sizes)[some])
        hits = np.bincount(owner[chosen[known[chosen]]], minlength=len(doc))
        near = chosen[known[chosen] & base[chosen]]
        pairs = np.unique(np.stack([pivots[place[near]], doc[owner[near]]]), axis=1) if len(near) else np.zeros((2, 0), np.int64)
        chosen = chosen[~known[chosen]]
        bucket = (textbytes.mix(hashes[chosen]) % np.uint64(buckets)).astype(np.int32)
        chosen = chosen[np.argsort(bucket, kind="stable")]
        bucket = np.sort(bucket)
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(1, np.int64)
        rows: list[list] = [[], [], [], [], []]
        for i, (a, b) in enumerate(zip(cuts, np.append(cuts[1:], len(chosen)))):
            k = chosen[a:b]
            rows[0].append(int(bucket[a]) if len(bucket) else 0)
            rows[1].append(textbytes.planes(hashes[k]))
            rows[2].append(textbytes.planes(doc[owner[k]] * 2 + base[k]))
            rows[3].append(b"" if i else b"".join(textbytes.planes(np.ascontiguousarray(p)) for p in pairs))
            rows[4].append(b"" if i else b"".join(textbytes.planes(x.astype(np.int64)) for x in (doc, sizes, sums.view(np.int64), hits)))
        kinds = [pa.int32(), *[pa.binary()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], ["bucket", "h", "doc", "near", "sizes"])


def _split(raw: bytes, parts: int) -> list[np.ndarray]:
    return [textbytes.numbers(x.tobytes(), np.int64) for x in np.frombuffer(raw, np.uint8).reshape(parts, -1)]


def _regions_of_bucket(rows: pa.Table) -> pa.Table:
    """Kind 0: text ``x``, size ``y`` and sum ``sig`` of its set. Kind 1: pivot ``x``, text ``y``.
    Kind 2: text ``x`` and the number ``y`` of its shingles here that another text has."""
    h = np.concatenate([textbytes.numbers(v.as_py(), np.uint64) for v in rows.column("h")])
    code = np.concatenate([textbytes.numbers(v.as_py(), np.int64) for v in rows.column("doc")])
    order = np.lexsort((code, h))
    h, doc, base = h[order], code[order] >> 1, (code[order] & 1).astype(bool)
    new = np.append(True, h[1:] != h[:-1]) if len(h) else np.zeros(0, bool)
    many = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1 if len(h) else new
    shared, times = np.unique(doc[many], return_counts=True)
    h, doc = h[many & base], doc[many & base]
    new = np.append(True, h[1:] != h[:-1]) if len(h) else np.zeros(0, bool)
    pivot = doc[new][np.cumsum(new) - 1]
    pairs = [np.stack([pivot[~new], doc[~new]])]
    pairs += [np.stack(_split(v.as_py(), 2)) for v in rows.column("near") if len(v.as_py())]
    x, y = np.unique(np.concatenate(pairs, axis=1), axis=1)
    x, y = x[x != y], y[x != y]
    sizes = [_split(v.as_py(), 4) for v in rows.column("sizes") if len(v.as_py())]
    doc, size, sig, hits = (np.concatenate([s[i] for s in sizes]) if sizes else np.zeros(0, np.int64) for i in range(4))
    parts = [(0, doc, size, sig), (1, x, y, y), (2, shared, times, times), (2, doc[hits > 0], hits[hits > 0], hits[hits > 0])]
    kind = np.concatenate([np.full(len(x), k, np.int32) for k, x, _, _ in parts])
    columns = [kind, *(np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))]
    return pa.table([pa.array(c) for c in columns], names=["kind", "x", "y", "sig"])


class Groups:
    """Union of texts into groups."""

    def __init__(self, label: np.ndarray):
        self.label = label.copy()

    def join(self, members: np.ndarray) -> None:
        old = np.unique(self.label[members])
        if len(old) > 1:
            self.label[np.isin(self.label, old)] = old[0]


def link(sizes: np.ndarray, hashes: np.ndarray, label: np.ndarray, active: np.ndarray, from_pivot: np.ndarray | None) -> np.ndarray:
    """Group labels after all links with an ``active`` text have been found.

    ``label``: groups known before. ``from_pivot``: distances from the pivot of the region.
    """
    groups = Groups(label)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    need = (NEED * sizes + OF - 1) // OF
    alive = sizes > 0
    while True:  # a text links with another only if enough of its shingles occur elsewhere here
        mine = alive[owner]
        values, inverse, counts = np.unique(hashes[mine], return_inverse=True, return_counts=True)
        shared = np.bincount(owner[mine][counts[inverse] > 1], minlength=len(sizes))
        drop = alive & (shared < need)
        if not drop.any():
            break
        alive &= ~drop
    keep = np.flatnonzero(mine)[counts[inverse] > 1]
    owner, number = owner[keep], inverse[counts[inverse] > 1]
    bounds = np.searchsorted(owner, np.arange(len(sizes) + 1))
    member = np.zeros(len(values), bool)
    waiting = alive & active
    other = alive.copy()  # texts that a waiting one still may have to meet
    while waiting.any():
        names, where, many = np.unique(groups.label[other], return_inverse=True, return_counts=True)
        if len(names) < 2:
            break
        own = np.full(len(sizes), np.iinfo(np.int64).max)
        own[np.flatnonzero(other)] = many[where]
        x = int(np.argmin(np.where(waiting, own, np.iinfo(np.int64).max)))
        member[number[bounds[x] : bounds[x + 1]]] = True
        common = np.bincount(owner, member[number], len(sizes)).astype(np.int64)
        member[number[bounds[x] : bounds[x + 1]]] = False
        near = other & (OF * common >= NEED * (sizes + sizes[x] - common)) & (groups.label != groups.label[x])
        if from_pivot is not None:
            near &= np.abs(from_pivot - from_pivot[x]) <= RADIUS + 1e-9
        groups.join(np.append(np.flatnonzero(near), x))
        waiting[x] = other[x] = False
        if not active.all():
            continue
        # texts of a group that nothing outside waits for need no turn of their own
        if len(np.unique(groups.label[other])) < 2:
            break
    return groups.label


def _read_sets(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    unpack = zstandard.ZstdDecompressor()
    texts = pa.array([unpack.decompress(t.as_py()) for t in rows.column("text")], pa.large_binary())
    found = list(sets(texts))
    return np.concatenate([s for _, s, _ in found]), np.concatenate([h for _, _, h in found])


def _distances(sizes: np.ndarray, hashes: np.ndarray, pivot: int) -> np.ndarray:
    start = int(sizes[:pivot].sum())
    common = np.bincount(np.repeat(np.arange(len(sizes)), sizes), np.isin(hashes, hashes[start : start + sizes[pivot]]), len(sizes))
    return 1 - common / np.maximum(sizes + sizes[pivot] - common, 1)


LINK_SCHEMA = "kind int, u long, v long, d double"


def _links(kind: np.ndarray, u: np.ndarray, v: np.ndarray, d: np.ndarray) -> pa.Table:
    return pa.table([pa.array(kind.astype(np.int32)), pa.array(u), pa.array(v), pa.array(d)], names=["kind", "u", "v", "d"])


def _forest(doc: np.ndarray, label: np.ndarray) -> pa.Table:
    """Kind 0: each text linked to the first of its group."""
    first = np.full(len(doc), np.iinfo(np.int64).max)
    np.minimum.at(first, label, doc)
    u, v = doc, first[label]
    far = u != v
    return _links(np.zeros(int(far.sum())), u[far], v[far], np.zeros(int(far.sum())))


def _join_region(rows: pa.Table) -> pa.Table:
    """A whole region: the links that join its groups. A part of a large one: the links to
    the pivot, and as kind 1 the distance ``d`` of every text ``v`` from the pivot ``u``."""
    doc, pivot = rows.column("doc").to_numpy(), rows.column("pivot")[0].as_py()
    sizes, hashes = _read_sets(rows)
    at = int(np.flatnonzero(doc == pivot)[0])
    d = _distances(sizes, hashes, at)
    inside = (d <= RADIUS + 1e-12) & (sizes > 0)
    label = np.arange(len(doc))
    label[inside] = at
    if rows.column("parts")[0].as_py() == 1:
        label = link(sizes, hashes, label, np.ones(len(doc), bool), d)
        return _forest(doc, label)
    rest = np.arange(len(doc)) != at
    return pa.concat_tables([_forest(doc, label), _links(np.ones(int(rest.sum())), np.full(int(rest.sum()), pivot), doc[rest], d[rest])])


def _join_block(rows: pa.Table) -> pa.Table:
    """A block of one ring, and texts outside the radius that may be near it."""
    rows = rows.sort_by([("doc", "ascending"), ("guest", "descending")])
    doc, guest, d = (rows.column(n).to_numpy() for n in ("doc", "guest", "d"))
    first = np.append(True, doc[1:] != doc[:-1])
    rows = rows.filter(pa.array(first))
    doc, guest, d = doc[first], guest[first], d[first]
    sizes, hashes = _read_sets(rows)
    label = np.arange(len(doc))
    inside = np.flatnonzero(d <= RADIUS + 1e-12)
    label[inside] = inside[0] if len(inside) else 0
    return _forest(doc, link(sizes, hashes, label, guest > 0, d))


def links(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sizes (``doc, size``) and links (``u, v``) that make the components of the join."""
    spark = keyed.sparkSession
    ship(spark)
    buckets = BUCKETS * partitions(spark)
    texts = keyed.select("doc", "text")
    known = spark.sparkContext.broadcast(frequent_shingles(texts))
    blobs = texts.mapInArrow(lambda x: _send_prefixes(x, *known.value, buckets), BLOB_SCHEMA)
    found = stored(blobs.groupBy("bucket").applyInArrow(lambda t: _regions_of_bucket(t), ROW_SCHEMA), "regions")

    sizes = found.where("kind = 0").select(F.col("x").alias("doc"), F.col("y").alias("size"), "sig").distinct()
    first = sizes.where("size > 0").groupBy("size", "sig").agg(F.min("doc").alias("first"))
    same = stored(sizes.where("size > 0").join(first, ["size", "sig"]).where("doc != first").select("doc", "first"), "equal")
    # a text must share as many shingles as the smallest text that it may link with has extra
    shared = found.where("kind = 2").groupBy(F.col("x").alias("doc")).agg(F.sum("y").alias("shared"))
    need = F.greatest(F.lit(1), F.floor(EXTRA * F.ceil(F.col("size") * NEED / OF) / 100))
    able = stored(shared.join(sizes, "doc").where(F.col("shared") >= need).select("doc"), "able")
    # texts with equal sets are represented by the first of them
    pairs = found.where("kind = 1").select(F.col("x").alias("pivot"), F.col("y").alias("doc")).distinct()
    pairs = pairs.join(able, "doc", "left_semi").join(same.select("doc"), "doc", "left_anti")
    moved = same.select(F.col("doc").alias("pivot"), "first")
    pairs = pairs.join(moved, "pivot", "left").select(F.coalesce("first", "pivot").alias("pivot"), "doc")
    pairs = stored(pairs.where("pivot != doc").distinct(), "pairs")

    # a region needs two texts that may link; its pivot may be one of them
    alone = able.select(F.col("doc").alias("pivot"), F.lit(1).alias("able"))
    volume = pairs.join(sizes.select("doc", "size"), "doc").groupBy("pivot").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    counts = volume.join(alone, "pivot", "left").where("n > 1 or able = 1")
    counts = counts.select("pivot", F.ceil(F.greatest(F.col("n") / REGION, F.col("shingles") / REGION_SHINGLES)).cast("int").alias("parts"))
    dealt = pairs.join(counts, "pivot").select("pivot", "doc", "parts", F.pmod(F.xxhash64("doc"), "parts").cast("int").alias("part"))
    dealt = stored(dealt, "dealt")
    own = counts.select("pivot", F.col("pivot").alias("doc"), "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    # only texts that are in a region are moved
    asked = dealt.select("doc").union(own.select("doc")).distinct()
    kept = only(texts, asked, "doc")
    packed = kept.mapInArrow(textbytes.squeezed, "doc long, text binary").dropDuplicates(["doc"])
    region = dealt.union(own).join(packed, "doc")
    joined = stored(region.groupBy("pivot", "part").applyInArrow(lambda t: _join_region(t), LINK_SCHEMA), "links")
    out = same.select(F.col("doc").alias("u"), F.col("first").alias("v")).union(joined.where("kind = 0").select("u", "v"))

    rings = joined.where("kind = 1").select(
        F.col("u").alias("pivot"), F.col("v").alias("doc"), "d", F.floor(F.col("d") / RADIUS - 1e-9).cast("int").alias("ring")
    )
    outside = rings.where(F.col("d") > RADIUS + 1e-12)
    if not outside.isEmpty():
        tasks = F.ceil(F.greatest(F.count("*") / REGION, F.sum("size") / REGION_SHINGLES)).cast("int")
        volume = sizes.select("doc", "size")
        blocks = rings.join(volume, "doc").groupBy("pivot", "ring").agg(tasks.alias("blocks"))
        hosts = rings.join(blocks, ["pivot", "ring"]).withColumn("block", F.pmod(F.xxhash64("doc"), "blocks").cast("int"))
        reach = outside.withColumn("ring", F.explode(F.array(*[F.col("ring") + i for i in (-1, 0, 1)])))
        guests = reach.join(blocks, ["pivot", "ring"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        # guests come in blocks as well, so that no task holds more than two blocks
        turns = outside.join(volume, "doc").groupBy("pivot").agg(tasks.alias("turns"))
        guests = guests.join(turns, "pivot").withColumn("turn", F.pmod(F.xxhash64("doc", F.lit(1)), "turns").cast("int"))
        hosts = hosts.join(turns, "pivot").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
        keys = ["pivot", "ring", "block", "turn", "doc", "d"]
        both = hosts.select(*keys, F.lit(0).alias("guest")).union(guests.select(*keys, F.lit(1).alias("guest")))
        blocks_in = both.join(packed, "doc")
        more = blocks_in.groupBy("pivot", "ring", "block", "turn").applyInArrow(lambda t: _join_block(t), LINK_SCHEMA)
        out = out.union(more.select("u", "v"))
    return sizes.select("doc", "size"), out


def report(docs: DataFrame) -> DataFrame:
    """For every document: ``doc_id, n_shingles, component_id``."""
    keyed = with_key(docs.select("doc_id", "text"))
    sizes, found = links(keyed)
    labels = components(found).withColumnRenamed("node", "doc")
    names = keyed.groupBy(F.col("doc").alias("component")).agg(F.min("doc_id").alias("component_id"))
    rows = keyed.select("doc", "doc_id").join(sizes, "doc", "left").join(labels, "doc", "left")
    rows = rows.withColumn("component", F.coalesce("component", "doc"))
    out = rows.join(names, "component", "left")
    return out.select("doc_id", F.coalesce("size", F.lit(0)).cast("long").alias("n_shingles"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id.

    Of repeated rows of that document one stays.
    """
    keyed = with_key(whole_rows(docs))
    labels = components(links(keyed)[1]).where("node != component").select(F.col("node").alias("doc"))
    return keyed.join(labels, "doc", "left_anti").dropDuplicates(["doc"]).select("row.*")
