"""Conversation prefix trie: which beginnings do conversations share, and what does that save?

A conversation is the sequence of its turns, a turn one 16-byte symbol (from the SHA-256 of role and
text), so a conversation is a binary string and texts are read once and never moved
(:func:`turn_symbols`). Equal conversations are counted before anything else, however many there are.

The trie of all of them is built in parts. Sequences are sorted over all tasks and cut by ranges,
so parts share only the paths between the last sequence of one and the first of the next, and a
first turn that a third of all conversations have is cut like any other range. Each part makes a
Z-fast trie (:class:`ZFastTrie`):

* Compacted nodes: only where sequences part or end. A node stands for all depths of its edge, the
  interval from its parent's depth (exclusive) to its own.
* A hash table has each node under its *handle*: the prefix as long as the two-fattest number of
  that interval, the one that the highest power of two divides.
* The exit node of a sequence is found by fat binary search: of the depths still possible, look up
  the prefix as long as their two-fattest number; a hit moves the lower end to the depth of the
  node found, a miss moves the upper end below. That takes the logarithm of the length.
* Batches: exit nodes of a batch are all located in the trie as it is, then sequences are inserted
  from there, splitting edges and renewing the handles of the two halves.

The exit depth says what a sequence adds: nodes above it are shared with a sequence before, so each
node and each child is counted by exactly one sequence. Weights, leaves, and code points are summed
up the compacted trie; then every edge is expanded to one row for each depth. All sums are
additive, so rows of nodes on a path shared by two parts are simply added up; other rows are final.

``ends_sha256`` is a digest of the sorted ids of one node's conversations. Ids are joined in blocks
of ``BLOCK`` numbers first, and the digest runs over the sorted blocks of a node, so
no list of ids is held.

Null roles and texts are empty. Turns are ordered by ``turn`` (null first), equal turns by the
SHA-256 of role and text, so repeated rows are turns of their own. Rows without ``conv_id`` belong to no
conversation and are left out. An empty table has no nodes, not even a root. Only the named
columns are read. One conversation's symbols (16 bytes a turn) are held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storytide.llm.runtime import partitions, ship, stored
from storytide.workspace import broadcast_if_small

WIDTH = 16  # bytes of a turn's symbol
BATCH = 1024  # sequences located together
PART_TURNS = 100_000  # turns of distinct conversations in a part
BLOCK = 4096  # consecutive ids joined before the digest
HEAD = 100  # rebuilt conversations share turns with the one of this multiple
MOST_HEAD = 6  # fewer turns than this

NODES = (
    "key binary, parent_key binary, depth long, edge boolean, parent_edge boolean, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, weighted long, once long, ends string"
)


# ---------------------------------------------------------------- conversations


def turn_symbols(turns: DataFrame) -> DataFrame:
    """``conv_id, place, symbol, chars``: the turns of each conversation in order, from 1.

    ``symbol`` is the hexadecimal start of the SHA-256 of role and text. The window sorts symbols, not
    texts.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.sha2(whole, 256).alias("digest"), F.length(text).alias("chars")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", F.row_number().over(order).alias("place"), F.substring("digest", 1, 2 * WIDTH).alias("symbol"), "chars")


def rebuilt(symbols: DataFrame) -> DataFrame:
    """The turns of rebuilt conversations: the first ``h`` of the one whose id ends in 00, then the
    own ones after the first ``h`` (``h``: crc32 of the id modulo 6). A conversation that
    is left without turns has one row with a null place."""
    ids = symbols.select("conv_id").distinct()
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_HEAD).alias("h")
    convs = ids.select("conv_id", head, (F.col("conv_id") - F.col("conv_id") % HEAD).alias("base"))
    first = symbols.where((F.col("conv_id") % HEAD == 0) & (F.col("place") < MOST_HEAD)).withColumnRenamed("conv_id", "base")
    borrowed = convs.join(first, "base").where(F.col("place") <= F.col("h")).select("conv_id", "place", "symbol", "chars")
    own = symbols.withColumn("h", head).where(F.col("place") > F.col("h")).select("conv_id", "place", "symbol", "chars")
    none = ids.select("conv_id", *[F.lit(None).cast(symbols.schema[c].dataType).alias(c) for c in ("place", "symbol", "chars")])
    return borrowed.unionByName(own).unionByName(none)


def sequences(places: DataFrame) -> DataFrame:
    """``conv_id, sequence, chars`` from the places of each conversation (null places count as none)."""
    turn = F.when(F.col("place").isNotNull(), F.struct("place", "symbol", "chars"))
    rows = places.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = F.array_join(F.transform("turns", lambda t: t.symbol), "")
    return rows.select("conv_id", F.unhex(whole).alias("sequence"), F.transform("turns", lambda t: t.chars.cast("int")).alias("chars"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each key from its joined blocks, which come in order."""
    kinds = [pa.binary(), pa.string()]
    key, running = None, None
    for batch in batches:
        done: list[list] = [[], []]
        for mine, ids in zip(batch.column("key").to_pylist(), batch.column("ids")):
            if running is None or mine != key:
                if running is not None:
                    done[0].append(key)
                    done[1].append(running.hexdigest())
                key, running = mine, hashlib.sha256()
            else:
                running.update(b",")
            running.update(ids.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(done, kinds)], ["key", "ends"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], kinds[0]), pa.array([running.hexdigest()], kinds[1])], ["key", "ends"])


def _key(sequence: Column) -> Column:
    return F.unhex(F.substring(F.sha2(sequence, 256), 1, 2 * WIDTH))


def distinct_sequences(found: DataFrame) -> DataFrame:
    """``sequence, chars, n, conv_id, ends``: each sequence once, with its conversations counted."""
    rows = found.withColumn("key", _key(F.col("sequence")))
    counted = rows.groupBy("key").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.min_by("sequence", "conv_id").alias("sequence"), F.min_by("chars", "conv_id").alias("chars")
    )
    block = F.floor(F.col("conv_id") / BLOCK)
    blocks = rows.groupBy("key", block.alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    joined = blocks.select("key", "block", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    ordered = joined.repartition(partitions(found.sparkSession), "key").sortWithinPartitions("key", "block").select("key", F.col("ids").cast("binary").alias("ids"))
    return counted.join(ordered.mapInArrow(_digests, "key binary, ends string"), "key").drop("key")


# ---------------------------------------------------------------- the trie of a part


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that the highest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


def prefix_keys(sequence: bytes) -> list[bytes]:
    """A key for each prefix, from the empty one to the whole."""
    running = hashlib.blake2b(digest_size=WIDTH)
    keys = [running.digest()]
    for i in range(0, len(sequence), WIDTH):
        running.update(sequence[i : i + WIDTH])
        keys.append(running.digest())
    return keys


class ZFastTrie:
    """Compacted nodes in lists; node 0 is the root. A node's prefix is that of the sequence whose
    keys (and ``data``) it holds, up to its depth."""

    def __init__(self):
        self.depth, self.parent, self.keys, self.data = [0], [-1], [prefix_keys(b"")], [None]
        self.children: list[dict[bytes, int]] = [{}]
        self.handles: dict[bytes, int] = {}

    def above(self, node: int) -> int:
        return self.depth[self.parent[node]] if node else 0

    def _new(self, depth: int, parent: int, keys: list[bytes], data) -> int:
        node = len(self.depth)
        self.depth.append(depth)
        self.parent.append(parent)
        self.keys.append(keys)
        self.data.append(data)
        self.children.append({})
        self._attach(node)
        return node

    def _attach(self, node: int) -> None:
        """Under its parent by the next symbol, in the table by its handle."""
        above, keys = self.above(node), self.keys[node]
        self.children[self.parent[node]][keys[above + 1]] = node
        self.handles[keys[two_fattest(above, self.depth[node])]] = node

    def exit(self, keys: list[bytes], start: int = 0) -> tuple[int, int]:
        """The deepest node whose whole prefix the sequence has, by fat binary search below ``start``
        (a node of that kind), and the depth to which the sequence is in the trie."""
        low, high, node = self.depth[start], len(keys) - 1, start
        while low < high:
            at = two_fattest(low, high)
            found = self.handles.get(keys[at])
            if found is None:
                high = at - 1
            elif self.depth[found] < len(keys) and self.keys[found][self.depth[found]] == keys[self.depth[found]]:
                node, low = found, self.depth[found]
            else:  # it leaves the trie on the edge of the node found, below its handle
                return self.parent[found], self._common(keys, found, at)
        if low + 1 < len(keys) and (found := self.children[node].get(keys[low + 1])) is not None:
            return node, self._common(keys, found, low + 1)
        return node, low

    def _common(self, keys: list[bytes], node: int, low: int) -> int:
        """The depth to which a sequence agrees with the edge of a node; to ``low`` it does."""
        high = min(len(keys) - 1, self.depth[node])
        while low < high:
            middle = (low + high + 1) // 2
            if self.keys[node][middle] == keys[middle]:
                low = middle
            else:
                high = middle - 1
        return low

    def _insert(self, keys: list[bytes], data, start: int) -> int:
        node, depth = self.exit(keys, start)
        if depth > self.depth[node]:
            lower = self.children[node][keys[self.depth[node] + 1]]
            if depth < self.depth[lower]:  # on the edge: a node there, the old one below it
                del self.handles[self.keys[lower][two_fattest(self.depth[node], self.depth[lower])]]
                middle = self._new(depth, node, self.keys[lower], self.data[lower])
                self.parent[lower] = middle
                self._attach(lower)
                lower = middle
            node = lower
        if depth < len(keys) - 1:
            node = self._new(len(keys) - 1, node, keys, data)
        return node

    def insert(self, batch: list[tuple[list[bytes], object]]) -> list[int]:
        """The node at the end of each sequence. Exit nodes are located first: inserting never
        takes a node away or moves one, so they are where the second search begins."""
        located = [self.exit(keys)[0] for keys, _ in batch]
        return [self._insert(keys, data, start) for (keys, data), start in zip(batch, located)]


class _Sums:
    """What the conversations of one part say about the nodes of its trie.

    ``rows`` are sorted; those with ``n`` = 0 stand for the parts beside this one (the last sequence
    before, the first one behind). They split edges where the parts' paths split and are counted there.
    """

    def __init__(self, rows: list[dict]):
        self.trie = trie = ZFastTrie()
        ends: list[int] = []
        for i in range(0, len(rows), BATCH):
            ends += trie.insert([(prefix_keys(row["sequence"]), row["chars"]) for row in rows[i : i + BATCH]])
        size = len(trie.depth)
        self.count, self.least, self.ends = [0] * size, [None] * size, [None] * size
        self.shared, self.before = [False] * size, [False] * size  # on a path of another part; of the one before
        for i, (row, node) in enumerate(zip(rows, ends)):
            if row["n"]:
                self.count[node], self.least[node], self.ends[node] = row["n"], row["conv_id"], row["ends"]
                continue
            while node >= 0:
                self.shared[node] = True
                self.before[node] |= i == 0
                node = trie.parent[node]
        self.children, self.leaves, self.weighted, self.once = [0] * size, [0] * size, [0] * size, [0] * size
        for node in sorted(range(size), key=lambda x: -trie.depth[x]):  # children first
            self._add_to_parent(node)

    def _add_to_parent(self, node: int) -> None:
        trie, up = self.trie, self.trie.parent[node]
        if not self.count[node]:
            return
        if not trie.children[node]:
            self.leaves[node] = 1
        if up < 0:
            return
        total = sum(trie.data[node][trie.above(node) : trie.depth[node]])
        self.count[up] += self.count[node]
        self.least[up] = self.least[node] if self.least[up] is None else min(self.least[up], self.least[node])
        self.children[up] += not self.before[node]
        self.leaves[up] += self.leaves[node]
        self.weighted[up] += self.weighted[node] + self.count[node] * total
        self.once[up] += self.once[node] + (0 if self.before[node] else total)

    def expanded(self) -> Iterator[tuple]:
        """A row for each depth of each edge, as :data:`NODES`."""
        trie = self.trie
        for node in range(len(trie.depth)):
            if not self.count[node]:
                continue
            keys, low, high, up = trie.keys[node], trie.above(node), trie.depth[node], trie.parent[node]
            shared, least, n, leaves = self.shared[node], self.least[node], self.count[node], self.leaves[node]
            children, ends, weighted, once = self.children[node], self.ends[node], self.weighted[node], self.once[node]
            if up < 0:
                yield keys[0], None, 0, shared, False, least, None, n, children, leaves, weighted, once, ends
                continue
            for depth in range(high, low, -1):
                chars = trie.data[node][depth - 1]
                weighted += n * chars
                once += 0 if self.before[node] else chars
                top = up if depth - 1 == low else node
                yield (
                    keys[depth], keys[depth - 1], depth, shared, self.shared[top], least, self.least[top],
                    n, children, leaves, weighted, once, ends,
                )
                children, ends = int(not self.before[node]), None


_KINDS = [pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.bool_(), *[pa.int64()] * 7, pa.string()]
_NAMES = [x.strip().split(" ")[0] for x in NODES.split(",")]


def _nodes_of_part(part: pa.Table) -> pa.Table:
    rows = sorted(part.to_pylist(), key=lambda row: row["sequence"])
    columns = list(zip(*_Sums(rows).expanded()))
    return pa.table([pa.array(c, k) for c, k in zip(columns, _KINDS)], _NAMES)


def nodes(found: DataFrame) -> DataFrame:
    """The nodes of the trie of ``sequence, chars, n, conv_id, ends`` (sequences are distinct)."""
    spark = found.sparkSession
    ship(spark)
    found = stored(found, "sequences")
    turns = found.agg(F.sum(F.size("chars") + 1).alias("n")).first().n or 0
    parts = max(partitions(spark), -(-turns // PART_TURNS))
    cut = found.repartitionByRange(parts, "sequence").withColumn("part", F.spark_partition_id())
    cut = stored(cut, "parts")
    whole = F.struct("sequence", "chars")
    sides = cut.groupBy("part").agg(F.min(whole).alias("first"), F.max(whole).alias("last"))
    by_part = Window.orderBy("part")  # a row for each part
    sides = sides.withColumns({"left": F.lag("last").over(by_part), "right": F.lead("first").over(by_part)})
    sides = sides.select("part", F.explode(F.array("left", "right")).alias("side")).where("side is not null")
    guests = sides.select("part", "side.*", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("string").alias("ends"))
    rows = cut.unionByName(guests).groupBy("part").applyInArrow(lambda part: _nodes_of_part(part.drop_columns(["part"])), NODES)
    rows = stored(rows, "nodes")
    add = ("n_convs", "n_children", "n_leaves", "weighted", "once")
    met = rows.where("edge").groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.max("parent_edge").alias("parent_edge"),
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in add], F.max("ends").alias("ends"),
    )
    met = stored(met, "shared_nodes")
    tops = broadcast_if_small(met.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("top")))
    columns = ["key", "parent_key", "depth", "parent_edge", "conv_id", "parent_conv_id", *add, "ends"]
    every = rows.where("not edge").select(columns).unionByName(met.withColumn("parent_conv_id", F.lit(None).cast("long")).select(columns))
    named = every.join(tops, "parent_key", "left").withColumn("parent_conv_id", F.when(F.col("parent_edge"), F.col("top")).otherwise(F.col("parent_conv_id")))
    nothing = hashlib.sha256(b"").hexdigest()
    return named.select(
        "key", "parent_key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("weighted") - F.col("once")).alias("saved_tokens"), F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"),
    )


def report(turns: DataFrame) -> DataFrame:
    """The nodes of all rebuilt conversations (see :func:`rebuilt`), without their keys."""
    symbols = stored(turn_symbols(turns), "symbols")
    return nodes(distinct_sequences(stored(sequences(rebuilt(symbols)), "conversations"))).drop("key", "parent_key")
