"""Secret scans: keys, tokens and passwords in texts, by one automaton for all rules.

The rules (:data:`RULES`) are compiled into transition arrays (:mod:`storytide.llm.automaton`). Each text is read
once, as bytes and backwards, for all rules together: the automaton tells where a match of a rule
begins. From there its match is walked to the end; of each rule the leftmost matches that do
not overlap are taken, and those whose value is too short are dropped afterwards, so they do take up
their place. Texts are read in numpy, many places side by side, in the task that reads them; nothing
is shuffled and nothing depends on the number of rules but the size of the arrays.

Spans are in code points, their ends exclusive. Null and empty texts have none; there is no limit on the
length of a text or the number of spans. Repeated rows are scanned one by one, empty tables give empty
results. :func:`scan` puts the columns to carry into one struct, so they may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storytide.llm import textbytes
from storytide.llm.automaton import Compiled, Rule, compile_rules, matches
from storytide.llm.runtime import ship

# ``least`` counts the bytes of the last class. That of hexadecimal digits is in the pattern, as
# there is no fixed part that would make matches rare; runs of one class are disjoint either way.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 6, any_case=True),
    Rule("access", "AKIA[A-Z0-9]+", 16),
    Rule("hex", "[0-9a-f]{24,}"),
)
# Formats that their issuers have published.
RULES = BASE + (
    Rule("github", "(gh[pousr]_|github_pat_)[A-Za-z0-9_]+", 36),
    Rule("slack", "xox[abeoprs]-[0-9A-Za-z-]+", 10),
    Rule("google", "AIza[0-9A-Za-z_-]+", 35),
    Rule("stripe", "(sk|rk)_(live|test)_[0-9A-Za-z]+", 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 10),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
SPANS = "array<struct<kind:string,start:bigint,stop:bigint>>"


def find(texts: pa.Array, compiled: Compiled) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """(first row, row, its spans as (start, rule, stop) in order) for the rows of a column that have any."""
    for row, data, offsets in textbytes.chunks(texts):
        found = matches(data, offsets, compiled)
        if not found:
            continue
        edges = sorted({x for _, begin, end in found for x in (begin, end)})
        owner = np.searchsorted(offsets[1:], [x[1] for x in found], side="right")
        inner = (data & 0xC0) == 0x80  # bytes within a character
        before: dict[int, int] = {}
        last, total = 0, 0
        firsts = {int(offsets[i]) for i in owner}
        for edge in sorted({*edges, *firsts}):
            total += int(np.count_nonzero(inner[last:edge]))
            before[edge], last = total, edge
        spans: dict[int, list] = {}
        for i, (rule, begin, end) in zip(owner.tolist(), found):
            first = int(offsets[i])
            place = lambda x: x - first - before[x] + before[first]  # noqa: B023, E731
            spans.setdefault(i, []).append((place(begin), rule, place(end)))
        for i in sorted(spans):
            yield row, row + i, sorted(spans[i])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns to carry, by default all) and ``spans`` of each row of ``docs``,
    sorted by start and then in the order of the rules."""
    ship(docs.sparkSession)
    compiled = compile_rules(list(rules))
    names = [rule.name for rule in rules]
    sent = docs.select(F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("row"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
        for batch in batches:
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            for _, i, found in find(batch.column("text"), compiled):
                spans[i] = [{"kind": names[rule], "start": start, "stop": stop} for start, rule, stop in found]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(spans, pa.list_(item))], ["row", "spans"])

    spans = T.StructType.fromDDL(f"spans {SPANS}")["spans"]
    return sent.mapInArrow(run, T.StructType([sent.schema["row"], spans]))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; where spans overlap, by the kind of the
    first of them, once. Other columns stay as they are."""
    ship(docs.sparkSession)
    compiled = compile_rules(list(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            new: dict[int, str] = {}
            for _, i, found in find(column, compiled):
                text, done, parts = column[i].as_py(), 0, []
                for start, rule, stop in found:
                    if start >= done:
                        parts += [text[done:start], f"[{rules[rule].name}]"]
                    done = max(done, stop)
                new[i] = "".join([*parts, text[done:]])
            if new:
                mask = np.zeros(len(column), bool)
                mask[list(new)] = True
                column = pc.replace_with_mask(column, pa.array(mask), pa.array([new[i] for i in sorted(new)], column.type))
            yield pa.RecordBatch.from_arrays([batch.column("row"), column], ["row", "text"])

    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"] or [F.lit(None).cast("int").alias("none")]
    sent = docs.select(F.struct(*rest).alias("row"), "text")
    clean = sent.mapInArrow(run, sent.schema)
    return clean.select(*["text" if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.stop.cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of spans of each base rule, the digest of those spans, and all spans."""
    found = scan(docs, carry=["doc_id"])
    base = [rule.name for rule in BASE]
    count = lambda name: F.size(F.filter("spans", lambda x: x.kind == name)).cast("long").alias(f"n_{name}")
    counts = [count(name) for name in base]
    digest = F.sha2(_listed(F.filter("spans", lambda x: x.kind.isin(base))), 256)
    return found.select("row.doc_id", *counts, digest.alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
