"""Jaccard join, suffix-array dedup, chat, packing, token files, pipeline."""

import hashlib
import random
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from storytide.llm import chat, decontaminate, jaccard_join, packing, quality_rules, secret_scan, suffix_dedup, textbytes, token_files, tokens
from storytide.llm.components import components
from tests.llm import plain

ODD = ["", None, "x" * 99, "x" * 100, "x" * 350, "xy" * 200, "¬ a¬b § x", "A b c\x1cd\x85e", "ΣΑΣ é <|endoftext|>y", "don't 12345 ###"]


def near_copies(r, n, edits=12):
    base = ["".join(r.choice("abcdefghij") for _ in range(r.randint(1, 8))) for _ in range(120)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(r.randint(0, edits)):
            words[r.randrange(len(words))] = "".join(r.choice("klmnop") for _ in range(6))
        out.append(" ".join(words[: r.randint(90, 120)]))
    return out


@pytest.mark.parametrize("region", [1024, 8])
def test_jaccard_join_like_plain(spark, monkeypatch, region):
    monkeypatch.setattr(jaccard_join, "REGION", region)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 12)
    r = random.Random(region)
    passage = " ".join("".join(r.choice("qrstuv") for _ in range(5)) for _ in range(40))
    texts = [*ODD, "one two", "One  two", "one two three", *near_copies(r, 40, 9), *near_copies(r, 40, 25)]
    texts += [f"{passage} " + " ".join(str(r.random()) for _ in range(60)) for _ in range(30)]
    texts += texts[-3:]
    docs = list(enumerate(texts))
    r.shuffle(docs)
    rows = [(i, t, 0, "clash") for i, t in docs]
    got = jaccard_join.report(spark.createDataFrame(rows, "doc_id long, text string, size long, doc string").repartition(3))
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got.collect()} == plain.groups(docs)


def test_jaccard_join_of_repeated_rows_nulls_and_nothing(spark):
    same = "one two three four five six seven"
    rows = [(5, same), (5, same), (None, same), (7, "other words that are not the same"), (7, same), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(x.doc_id), x.n_shingles, x.component_id) for x in jaccard_join.report(docs).collect())
    assert got == [("5", 3, 5), ("5", 3, 5), ("7", 3, 5), ("7", 3, 7), ("9", 0, 9), ("None", 3, 5)]
    kept = jaccard_join.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((str(x.doc_id), str(x.text)[:3]) for x in kept.collect()) == [("5", "one"), ("7", "oth"), ("9", "Non")]
    assert jaccard_join.report(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(149, 200), (300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 150)} | {200: 100}


def repeated_texts(seed):
    r = random.Random(seed)
    letters = "abé " if seed % 3 else "abcdefghij klmnop"
    base = ["".join(r.choice(letters) for _ in range(r.randint(50, 900))) for _ in range(6)]
    out = []
    for _ in range(40):
        text = ""
        for _ in range(r.randint(1, 4)):
            b = r.choice(base)
            x = r.randint(0, len(b))
            text += b[x : r.randint(x, len(b))] + "".join(r.choice(letters) for _ in range(r.randint(0, 40)))
        out.append(text)
    return ODD + out


@pytest.mark.parametrize("seed", [0, 1])
def test_suffix_dedup_like_plain(spark, seed):
    docs = list(enumerate(repeated_texts(seed)))
    rows = [(t, 1, "clash", i) for i, t in docs]
    frame = spark.createDataFrame(rows, "text string, start int, bytes string, doc_id long").repartition(3)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.report(frame).collect()}
    want = plain.repeats(docs)
    assert got == {k: (*v[:3], hashlib.sha256(v[3]).hexdigest()) for k, v in want.items()}
    left = suffix_dedup.remove_repeats(frame)
    assert left.columns == frame.columns
    texts = {x.doc_id: x.text for x in left.collect()}
    assert texts[1] is None and all((texts[k] or "").encode() == v[3] for k, v in want.items() if v[3].isascii())


def test_suffix_dedup_of_repeated_rows_nulls_and_nothing(spark):
    rows = [(1, "a" * 40 + "b" * 80), (1, "a" * 40 + "b" * 80), (2, "b" * 40 + "a" * 40 + "b" * 80), (2, "c"), (None, "a" * 40 + "b" * 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(x.doc_id), x.n_bytes, x.n_removed) for x in suffix_dedup.report(docs).collect())
    assert got == [("1", 120, 0), ("1", 120, 0), ("2", 1, 0), ("2", 160, 120), ("None", 120, 120)]
    assert suffix_dedup.report(docs.limit(0)).count() == 0


@pytest.mark.parametrize("split", [2, 4096])
def test_shards_and_merging_like_plain(monkeypatch, split):
    """Buckets, shards and merging of runs, called as the jobs call them."""
    monkeypatch.setattr(suffix_dedup, "SPLIT", split)
    docs = list(enumerate(repeated_texts(5)))
    blobs = []
    for part in (docs[::2], docs[1::2]):
        columns = [pa.array([d for d, _ in part], pa.int64()), pa.array([t for _, t in part], pa.string())]
        blobs += suffix_dedup._find_anchors(iter([pa.RecordBatch.from_arrays(columns, ["doc", "text"])]), 5)
    table = pa.Table.from_batches(blobs)
    buckets = set(table["bucket"].to_pylist())
    marks = [suffix_dedup._settle_bucket(table.filter(pa.compute.equal(table["bucket"], b))).to_pylist() for b in buckets]
    marks = [m for part in marks for m in part]
    raw = {d: (t or "").encode() for d, t in docs}
    shards = {}
    for m in marks:
        if m["kind"] == 1:
            shards.setdefault((m["a"], m["part"]) if m["part"] else None, []).append(m | {"bytes": raw[m["doc"]][m["start"] : m["stop"]]})
    schema = pa.schema([("doc", pa.int64()), ("start", pa.int32()), ("a", pa.int64()), ("part", pa.int32()), ("bytes", pa.binary())])
    found = [x for rows in shards.values() for x in suffix_dedup._sort_shard(pa.Table.from_pylist(rows, schema)).to_pylist()]
    runs = [x for x in found if x["kind"] == 2]
    assert bool(runs) == (split == 2)
    spans = [x for x in marks + found if x["kind"] == 0]
    spans += suffix_dedup._merge_runs(pa.Table.from_pylist(runs)).to_pylist() if runs else []
    for doc_id, (_, removed, _, kept) in plain.repeats(docs).items():
        gone = bytearray(len(raw[doc_id]))
        for s in spans:
            if s["doc"] == doc_id:
                gone[s["start"] : s["stop"]] = b"\1" * (s["stop"] - s["start"])
        assert sum(gone) == removed and bytes(x for x, y in zip(raw[doc_id], gone) if not y) == kept


def test_words_and_hashes_of_bytes():
    texts = [t or "" for t in ODD] + [" a  bb\n", "é"]
    for _, data, offsets in textbytes.chunks(pa.array(texts), limit=64):
        starts, ends, first = textbytes.words(data, offsets)
        for i in range(len(offsets) - 1):
            mine = data[offsets[i] : offsets[i + 1]].tobytes()
            assert [data[a:b].tobytes() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])] == mine.split()
    data = np.frombuffer(b"abcabc", np.uint8)
    a, b, c = textbytes.spans(textbytes.running(data), np.array([0, 3, 1]), np.array([3, 6, 4]))
    assert a == b != c
    assert textbytes.numbers(textbytes.planes(np.arange(9) << 20), np.int64).tolist() == (np.arange(9) << 20).tolist()


def test_ids_of_texts_like_the_library():
    path = tokens.tokenizer_path()
    found = []
    for _, ids, bounds in tokens.WordEncoder(path).encode(pa.array(ODD * 2 + ["end"])):
        found += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch([t or "" for t in ODD * 2 + ["end"]], add_special_tokens=False)]
    assert found == want


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-1001 * bits // 8)
    for start, count in ((0, 1001), (5, 0), (123, 456), (1000, 1)):
        assert (token_files.unpack(packed, bits, start, count) == ids[start : start + count]).all()


def expected_ids(rows, end):
    library = Tokenizer.from_file(tokens.tokenizer_path())
    return [[*library.encode(t or "", add_special_tokens=False).ids, end] for _, t in rows]


def test_token_files_round_trip(spark, tmp_path):
    rows = sorted((i, t) for i, t in enumerate([t or "" for t in ODD] + ["some words"] * 3 + ["many words " * 60_000]))
    shuffled = random.Random(0).sample(rows, len(rows))
    docs = spark.createDataFrame([(t, "clash", i) for i, t in shuffled], "text string, payload string, doc_id long").repartition(3)
    token_files.write_token_files(docs, f"{tmp_path}/files")
    got = sorted(token_files.read_token_files(spark, f"{tmp_path}/files").collect())
    start = 0
    for row, (doc_id, _), ids in zip(got, rows, expected_ids(rows, 1)):
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32, row.ids) == (doc_id, start, len(ids), crc, ids)
        start += len(ids)
    token_files.write_token_files(docs.limit(0), f"{tmp_path}/none")
    assert token_files.read_token_files(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("group", [8, 16_384])
def test_packing_places_every_piece(spark, monkeypatch, group):
    r = random.Random(4)
    texts = [*ODD, *("word " * r.randint(1, 700) for _ in range(60)), "long text " * 3000, None]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, ODD[3]), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    parts = packing.stored(packing.pieces(docs), "pieces")
    placed = packing.pack(parts, group_pieces=group).collect()
    ids = expected_ids(rows, 0)
    assert len(placed) == sum(-(-len(x) // packing.SEQUENCE) for x in ids)
    crcs = sorted(zlib.crc32(np.array(x[i : i + packing.SEQUENCE], "<u4").tobytes()) for x in ids for i in range(0, len(x), packing.SEQUENCE))
    assert sorted(x.ids_crc32 for x in placed) == crcs
    sequences = {}
    for x in placed:
        assert x.start == x.piece * packing.SEQUENCE
        sequences.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for members in sequences.values():
        members.sort()
        assert [o for o, _ in members] == [sum(n for _, n in members[:i]) for i in range(len(members))]
        assert sum(n for _, n in members) <= packing.SEQUENCE
    least = -(-sum(map(len, ids)) // packing.SEQUENCE)
    assert len(sequences) <= least + 2
    assert packing.best_fit(docs.limit(0)).count() == 0


def test_packing_groups_stay_bounded(spark, monkeypatch):
    largest = []
    store = packing.stored

    def watched(df, name):
        out = store(df, name)
        if name.startswith("packed"):
            largest.append(max(r["count"] for r in out.groupBy("grp").count().collect()))
        return out

    monkeypatch.setattr(packing, "stored", watched)
    monkeypatch.setattr(packing, "GROUP_PIECES", 50)
    r = random.Random(6)
    long = [r.randint(1025, 2040) for _ in range(1000)]
    mixed = [r.choice([1500, 1500, r.randint(1, 2040)]) for _ in range(1000)]
    for lengths in (long, mixed):
        rows = [(i, 0, 0, n, i, i) for i, n in enumerate(lengths)]
        parts = store(spark.createDataFrame(rows, packing.PIECE_SCHEMA), "pieces")
        placed = packing.pack(parts, group_pieces=50).collect()
        assert sorted(x.doc_id for x in placed) == list(range(1000))
        filled = {}
        for x in placed:
            filled[x.sequence_id] = filled.get(x.sequence_id, 0) + x.length
        assert max(filled.values()) <= packing.SEQUENCE
    assert max(largest) <= 100


def test_sum_of_squares_rule_like_plain():
    r = random.Random(8)
    lengths, size = [r.randint(1, 20) for _ in range(300)], 20
    bins, offsets = packing.sum_of_squares(np.array(lengths), size)
    gaps = []
    for s, b, o in zip(lengths, bins, offsets):
        count = lambda g, gaps=gaps: sum(x == g for x in gaps)

        def cost(gap, s=s, count=count):
            after = {g: count(g) for g in range(1, size)}
            if gap < size:
                after[gap] -= 1
            if 0 < gap - s:
                after[gap - s] = after.get(gap - s, 0) + 1
            return sum(v * v for v in after.values())

        options = {cost(g) for g in {*gaps, size} if g >= s}
        mine = size if b == len(gaps) else gaps[b]
        assert o == size - mine and cost(mine) == min(options)
        gaps[b : b + 1] = [mine - s]


def test_reply_trees(spark):
    rows = [
        ("t", "a", None, "user", "hi", 0.0), ("t", "b", "a", "assistant", "one", 1.0), ("t", "c", "a", "assistant", "two", 2.0),
        ("t", "d", "b", "user", "more", 5.0), ("u", "e", "gone", None, None, None), ("v", "x", "y", "user", "loop", 1.0),
        ("v", "y", "x", "user", "loop", 1.0), ("v", "z", "y", "user", "loop", 1.0),
    ]
    chain = [("w", f"w{i:03}", f"w{i - 1:03}" if i else None, "user", str(i), 0.5) for i in range(100)]
    messages = spark.createDataFrame(rows + chain, "tree_id string, message_id string, parent_id string, role string, text string, score double")
    got = {(r.tree_id, r.path_rank): r for r in chat.read_back(chat.format_paths(messages)).collect()}
    assert {k: v.leaf for k, v in got.items()} == {("t", 1): "d", ("t", 2): "c", ("u", 1): "e", ("w", 1): "w099"}
    assert [t.text for t in got["t", 1].turns] == ["hi", "one", "more"] and got["t", 1].loss_text == "one"
    assert [t.text for t in got["w", 1].turns] == [str(i) for i in range(100)] and got["w", 1].path_score == 50.0
    assert [tuple(t) for t in got["u", 1].turns] == [("", "")]
    assert chat.format_paths(messages, best=1).where("tree_id = 't'").count() == 1
    assert chat.format_paths(messages.limit(0)).count() == 0


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abc\x00\xff"])
def test_suffix_order_and_common_prefixes(letters):
    r = random.Random(len(letters))
    unit = bytes(r.choice(letters) for _ in range(170))
    raw = b"".join(unit[r.randint(0, 60) : r.randint(100, 170)] + bytes(r.choice(letters) for _ in range(r.randint(0, 9))) for _ in range(14))
    data, size = np.frombuffer(raw, np.uint8), suffix_dedup.LENGTH
    valid = np.arange(len(raw) - size + 1)
    windows = [raw[i : i + size] for i in valid]
    ranks, shorter = suffix_dedup.suffix_order(data)
    assert [windows[i] for i in np.lexsort((valid, ranks[valid]))] == sorted(windows)
    assert len(np.unique(ranks[valid])) == len(set(windows))
    assert len(np.unique(shorter[valid])) == len({w[:64] for w in windows})
    others = np.array([r.randrange(len(valid)) for _ in valid])
    others[40:120] = np.arange(7, 87)
    common = suffix_dedup.common_prefixes(data, valid, others)
    same = lambda x, y: next((i for i in range(size) if x[i] != y[i]), size)
    assert common.tolist() == [same(windows[i], windows[j]) for i, j in zip(valid, others)]
    assert suffix_dedup.common_prefixes(data, valid[:0], others[:0]).tolist() == []


def test_runs_of_several_shards_are_merged():
    r = random.Random(8)
    rows = [{"part": r.randint(1, 6), "a": r.randint(0, 9), "b": r.randint(0, 1), "doc": r.randint(0, 30), "start": r.randint(0, 5)} for _ in range(300)]
    rows = [dict(x) for x in {tuple(sorted(row.items())) for row in rows}]
    spans = suffix_dedup._merge_runs(pa.Table.from_pylist(rows)).to_pylist()
    got = {(x["doc"], i) for x in spans for i in range(x["start"], x["stop"])}
    first = {}
    for row in rows:
        place = (row["doc"], row["start"])
        first[row["a"], row["b"]] = min(place, first.get((row["a"], row["b"]), place))
    # the earliest place of a window may be removed only where another window covers it
    want = {(x["doc"], i) for x in rows if (x["doc"], x["start"]) != first[x["a"], x["b"]] for i in range(x["start"], x["start"] + 100)}
    assert got == want


CLASHES = "doc_id long, text string, lang string, source string, n_chars int, doc string, x0 string, _q string, _spans string, spans string, row string, score string, `a b.c` string, _bad_id string"


def test_columns_of_any_name_come_back(spark):
    text = "".join(f"word{i} other{i * 7 % 13} " for i in range(70))
    rows = [(i, text + ("" if i % 2 else f" tail {i}"), "en", "s", 3, *[f"{c}{i}" for c in "abcdefghi"]) for i in range(6)]
    docs = spark.createDataFrame(rows, CLASHES)
    items = spark.createDataFrame([(1, "no such words here at all")], "item_id long, text string")
    for stage in (quality_rules.keep_good, jaccard_join.keep_first, suffix_dedup.remove_repeats, lambda d: decontaminate.remove(d, items), lambda d: decontaminate.remove(d, items, "spans"), secret_scan.redact):
        left = stage(docs)
        assert left.schema.names == docs.schema.names
        kept = left.collect()
        assert kept and all(tuple(r)[2:] == rows[r.doc_id][2:] for r in kept)


def test_ids_that_are_not_small_numbers(spark):
    same = "one two three four five six seven"
    large = [((1 << 62) + i, same if i % 2 else f"{same} and {i}") for i in range(4)]
    got = jaccard_join.report(spark.createDataFrame(large, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: v[1] for i, v in plain.groups(large).items()}
    names = spark.createDataFrame([("b", same), ("a", same), ("c", "else")], "doc_id string, text string")
    assert {r.doc_id: r.component_id for r in jaccard_join.report(names).collect()} == {"a": "a", "b": "a", "c": "c"}


def test_long_chains_do_not_make_large_plans(spark):
    rows = [(f"m{i:04}", f"m{i - 1:04}" if i else None, None if i % 7 == 0 else 1.0, "clash", i) for i in range(1000)]
    rows += [(f"s{i}", "m0400", float(i), "clash", 0) for i in range(6)]
    messages = spark.createDataFrame(rows, "message_id string, parent_id string, score double, leaf string, distance int")
    found = chat.chosen_paths(messages.withColumn("tree_id", F.lit(1)), best=3)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 2
    sizes = {r.leaf: (r.path_rank, r.path_score, r.n) for r in found.groupBy("leaf", "path_rank", "path_score").agg(F.count("*").alias("n")).collect()}
    to_400 = sum(i % 7 != 0 for i in range(401))
    assert sizes == {"m0999": (1, float(sum(i % 7 != 0 for i in range(1000))), 1000), "s5": (2, to_400 + 5.0, 402), "s4": (3, to_400 + 4.0, 402)}
    listed = chat.paths(messages.where("message_id like 's%' or message_id <= 'm0400'")).groupBy("leaf").count().collect()
    assert {r["leaf"]: r["count"] for r in listed} == {f"s{i}": 402 for i in range(6)}


def test_ranks_of_a_tree_with_many_leaves(spark):
    rows = [("r", None, 0.0, 1)] + [(f"c{i:04}", "r", float(i % 50), 1) for i in range(900)] + [("q", None, 1.0, None)]
    messages = spark.createDataFrame(rows, "message_id string, parent_id string, score double, tree_id int")
    got = {(r.tree_id, r.leaf): r.path_rank for r in chat.chosen_paths(messages).where("distance = 0").collect()}
    best = sorted(rows[1:-1], key=lambda x: (-x[2], x[0]))
    assert got == {(1, x[0]): i + 1 for i, x in enumerate(best)} | {(None, "q"): 1}


def thue_morse():
    """Two words that collide under any polynomial modulo 2**64."""
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_with_equal_hashes(spark):
    a, b = thue_morse()
    rows = [(1, a), (2, b), (3, f"{b} {a} and {b}"), (4, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = tokens.encoder(tokens.tokenizer_path()).tokenizer
    crc = lambda text, end: zlib.crc32(np.array([*plain.encode(text, add_special_tokens=False).ids, end], "<u4").tobytes())
    with tempfile.TemporaryDirectory() as folder:
        token_files.write_token_files(docs, f"{folder}/t")
        assert {r.doc_id: r.ids_crc32 for r in token_files.read_token_files(spark, f"{folder}/t").collect()} == {i: crc(x, 1) for i, x in rows}
    pieces = packing.best_fit(docs.where("doc_id != 3")).where("start = 0").collect()
    ids = {i: [*plain.encode(x, add_special_tokens=False).ids, 0][:2048] for i, x in rows}
    assert {r.doc_id: r.ids_crc32 for r in pieces} == {i: zlib.crc32(np.array(ids[i], "<u4").tobytes()) for i in (1, 2, 4)}
    assert {r.doc_id: r.component_id for r in jaccard_join.report(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 1}


def test_a_word_is_what_its_bytes_say(monkeypatch):
    texts = ["one two three four", "two one, Three! four five", "", "six " * 40 + "seven", "x¬y one"] * 3
    plain = tokens.encoder(tokens.tokenizer_path())
    coarse = tokens.WordEncoder(tokens.tokenizer_path())
    monkeypatch.setattr(coarse, "_hashes", lambda data, starts, ends: textbytes.hashed(data, starts, ends) % np.uint64(3))
    for row, ids, bounds in coarse.encode(pa.array(texts)):
        for i in range(len(bounds) - 1):
            assert list(ids[bounds[i] : bounds[i + 1]]) == plain._raw([texts[row + i]])[0]


def test_chat_texts_come_back_whatever_they_hold(spark):
    bits = ["<|im_end|>\n", "<|im_start|>assistant\n", "<", "|", "\\", "\n", "<\\|", "<\\\\|", "$1", "é😀", "\\n", ""]
    r = random.Random(6)
    make = lambda: "".join(r.choice(bits) for _ in range(r.randint(0, 8)))
    rows = [(c, t, r.choice(["user", "assistant", make(), None]), r.choice([make(), None])) for c in range(40) for t in range(r.randint(1, 6))]
    rows += [(None, None, "assistant", "x"), (1, 0, "assistant", "tie"), (1, 0, "assistant", "tie")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    key = lambda x: [(v is not None, v if v is not None else 0) for v in x[1:2]] + [(v is not None, v or "") for v in x[2:]]
    got = {x.conv_id: x for x in chat.report(turns).collect()}
    assert set(got) == {x[0] for x in rows}
    for conv, row in got.items():
        mine = sorted((x for x in rows if x[0] == conv), key=key)
        whole = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in mine)
        learnt = "".join(x[3] or "" for x in mine if x[2] == "assistant")
        assert row.n_turns == len(mine) and row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    columns, rows = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.stored(stage(spark, docs, sf), name)
        assert docs.columns == columns
        rows = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality_rules":
            failed = {k for k, t in before.items() if plain.counts(t)[5]}
            assert not failed & set(rows) and set(rows) <= set(before) and len(rows) > 0.6 * len(before)
        elif name == "jaccard_join":
            assert set(rows) == {k for k, (_, first) in plain.groups(list(before.items())).items() if k == first}
        elif name == "suffix_dedup":
            want = plain.repeats(list(before.items()))
            assert rows == {k: v[3].decode("utf-8", "ignore") for k, v in want.items()} or sum(
                rows[k] != v[3].decode("utf-8", "ignore") for k, v in want.items()
            ) <= sum(not v[3].isascii() and v[1] > 0 for v in want.values())
        else:
            assert set(rows) == {k for k, v in plain.hits(list(before.items()), items).items() if not v[4]}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {x.doc_id for x in packed} == set(rows)
