"""Chat formatting: reply trees to conversations with marked turns and a loss mask.

Messages name the message they answer. Self-joins double the reach of each message's pointer, and
the sum of scores along it, until all end at a root. Leaves climb these pointers to their root, so
that the branches of a tree are ranked by the sum of their scores before any path is listed; then
the chosen leaves get their ancestors in as many joins, and each chosen path becomes one
conversation in text. Every step is stored, so its plan has one join however long the paths are.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts every ``<``, any number of
backslashes, ``|`` gets one more backslash, so no control string can come from a text, and taking
it away gives the text back (:func:`read_back`). The loss mask is a list of spans of the formatted
text, in characters: the texts of the assistant, without marks.

Null roles and texts are empty, null scores 0. A parent that does not exist makes a root. Messages on a cycle, and
those that answer them, have no root and are in no path. Repeated message ids are not allowed
in trees; :func:`from_turns` numbers the rows of a conversation by turn, then role and text (nulls
first), so repeated rows are turns of their own. Null conversations are one conversation. Empty
tables give no conversations. Only the named columns are read; others, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storytide.llm.runtime import partitions, stored

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """Also without line ends, as the first one ends a role."""
    doubled = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    return escape(F.replace(doubled, F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    doubled = unescape(role)
    lines = F.regexp_replace(doubled, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(lines, F.lit("\\\\"), F.lit("\\"))


def _stored_ids(messages: DataFrame) -> DataFrame:
    """The columns that the joins need, computed once; texts stay where they are."""
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score") if "score" in messages.columns else F.lit(0.0).alias("score")
    tree = F.col("tree_id") if "tree_id" in messages.columns else F.lit(None).cast("long").alias("tree_id")
    return stored(messages.select("message_id", "parent_id", tree, score), "messages")


def _jumps(ids: DataFrame) -> list[DataFrame]:
    """For 1, 2, 4, ... steps up: ``message_id``, the ancestor ``up`` and the scores met on the
    way (``gain``: those after the message, ``up`` included). Each is stored, so a plan has one join.
    """
    above = ids.select(F.col("message_id").alias("up"), F.col("score").alias("gain"))
    jumps = [stored(ids.join(above, F.col("parent_id") == F.col("up")).select("message_id", "up", "gain"), "up0")]
    limit = max(1, ids.count()).bit_length()  # messages on a cycle never run out of ancestors
    while len(jumps) <= limit:
        last = jumps[-1]
        more = last.select(F.col("message_id").alias("up"), F.col("up").alias("top"), F.col("gain").alias("more"))
        further = last.join(more, "up").select("message_id", F.col("top").alias("up"), (F.col("gain") + F.col("more")).alias("gain"))
        step = stored(further, f"up{len(jumps)}")
        if step.isEmpty():
            break
        jumps.append(step)
    return jumps


def _leaves(ids: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """``leaf, tree_id, path_score`` of every leaf below a root: one climb by the longest jumps first."""
    answered = ids.select(F.col("parent_id").alias("message_id")).where("message_id is not null").distinct()
    ends = ids.join(answered, "message_id", "left_anti")
    at = ends.select(F.col("message_id").alias("leaf"), "tree_id", F.col("message_id").alias("at"), F.col("score").alias("path_score"))
    at = stored(at, "leaves")
    for k in reversed(range(len(jumps))):
        step = jumps[k].select(F.col("message_id").alias("at"), "up", "gain")
        gain = F.coalesce("gain", F.lit(0.0))
        up = at.join(step, "at", "left")
        at = stored(up.select("leaf", "tree_id", F.coalesce("up", "at").alias("at"), (F.col("path_score") + gain).alias("path_score")), f"climb{k}")
    return at.join(jumps[0].select(F.col("message_id").alias("at")), "at", "left_anti").drop("at")


def _ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``path_rank`` in their tree, by score and then by leaf.

    Leaves are sorted over all tasks, so that a tree with very many of them is shared out; a leaf's
    rank is its place in its part of the tree behind the leaves of the parts before.
    """
    order = [F.col("tree_id").asc_nulls_first(), F.col("path_score").desc(), F.col("leaf")]
    spread = leaves.repartitionByRange(partitions(leaves.sparkSession), *order)
    parts = stored(spread.withColumn("part", F.spark_partition_id()), "ranked_leaves")
    sizes = parts.groupBy("tree_id", "part").agg(F.count("*").alias("size"))
    before = Window.partitionBy("tree_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("tree_id").alias("tree"), F.col("part").alias("in_part"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("tree_id", "part").orderBy(F.desc("path_score"), "leaf"))
    placed = parts.withColumn("inside", inside)
    same = F.col("tree_id").eqNullSafe(F.col("tree")) & (F.col("part") == F.col("in_part"))
    return placed.join(offsets, same).select("leaf", "tree_id", "path_score", (F.col("offset") + F.col("inside")).alias("path_rank"))


def _listed(leaves: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """``leaf, message_id, distance``: each leaf with its ancestors, itself at distance 0.

    With the jumps of 2**k steps every message found so far gets the one 2**k above it; what was
    found is stored each time, so no plan holds the ones before.
    """
    found = stored(leaves.select("leaf", F.col("leaf").alias("message_id"), F.lit(0).cast("long").alias("distance")), "paths")
    for k in reversed(range(len(jumps))):
        above = found.join(jumps[k], "message_id")
        above = above.select("leaf", F.col("up").alias("message_id"), (F.col("distance") + (1 << k)).alias("distance"))
        found = stored(found.union(above), f"paths{k}")
    return found


def paths(messages: DataFrame) -> DataFrame:
    """``leaf, message_id, distance`` of all leaves below roots."""
    ids = _stored_ids(messages)
    jumps = _jumps(ids)
    return _listed(_leaves(ids, jumps), jumps)


def chosen_paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """:func:`paths` with ``tree_id``, ``path_score`` and ``path_rank``, the ``best`` of each tree.

    Scores are summed and paths ranked before any path is listed.
    """
    ids = _stored_ids(messages)
    jumps = _jumps(ids)
    ranked = _ranked(_leaves(ids, jumps))
    if best is not None:
        ranked = ranked.where(F.col("path_rank") <= best)
    ranked = stored(ranked, "ranked")
    return _listed(ranked, jumps).join(ranked, "leaf")


def format_paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """``tree_id, leaf, path_rank, path_score, formatted, loss_spans`` of the chosen paths."""
    found = chosen_paths(messages, best).join(messages.select("message_id", "role", "text"), "message_id")
    text = escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(START), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    turn = F.struct(
        (-F.col("distance")).alias("place"), head.alias("head"), text.alias("text"), F.coalesce(F.col("role") == ASSISTANT, F.lit(False)).alias("learn")
    )
    rows = found.groupBy("leaf", "tree_id", "path_rank", "path_score").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t.head, t.text, F.lit(END))), "")
    zero = F.lit(0).cast("long")
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")

    def step(done: Column, t: Column) -> Column:
        start = done.at + F.length(t.head)
        stop = start + F.length(t.text)
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct(
            (stop + F.length(F.lit(END))).alias("at"), F.when(t.learn, F.concat(done.spans, span)).otherwise(done.spans).alias("spans")
        )

    spans = F.aggregate("turns", F.struct(zero.alias("at"), none.alias("spans")), step, lambda done: done.spans)
    return rows.select("tree_id", "leaf", "path_rank", "path_score", formatted.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` (role and text) and ``loss_text``, both read from the text."""
    parts = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda x: x != "")
    bare = F.transform(parts, lambda x: F.substring(x, len(START) + 1, 1 << 30))
    turns = F.transform(
        bare,
        lambda x: F.struct(
            unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
            unescape(F.substr(x, F.length(F.substring_index(x, "\n", 1)) + 2)).alias("text"),
        ),
    )
    learnt = F.transform("loss_spans", lambda s: unescape(F.substr("formatted", (s.start + 1).cast("int"), (s.stop - s.start).cast("int"))))
    return formatted.withColumns({"turns": turns, "loss_text": F.array_join(learnt, "")})


def from_turns(turns: DataFrame) -> DataFrame:
    """Conversations (``conv_id, turn, role, text``) as trees that are chains of turns."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = turns.select("conv_id", "role", "text", F.row_number().over(order).alias("place"))
    tree = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))
    name = lambda place: F.concat_ws(":", tree, place.cast("string"))
    return placed.select(
        F.col("conv_id").alias("tree_id"),
        name(F.col("place")).alias("message_id"),
        F.when(F.col("place") > 1, name(F.col("place") - 1)).alias("parent_id"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def report(turns: DataFrame) -> DataFrame:
    """One row for each conversation with digests of what :func:`read_back` gives."""
    rows = read_back(format_paths(stored(from_turns(turns), "turns")))
    plain = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return rows.select(
        F.col("tree_id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(plain, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
