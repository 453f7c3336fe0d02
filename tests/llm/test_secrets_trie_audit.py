"""Secret scans, conversation tries, filter audits: beside plain Python, on edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from storytide.llm import automaton, conversation_trie, filter_audit, secret_scan

KEY = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
PLAIN = {
    "assign": (rf"""(?:{KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    "access": ("AKIA([A-Z0-9]+)", 16),
    "hex": ("([0-9a-f]+)", 24),
    "github": ("(?:gh[pousr]_|github_pat_)([A-Za-z0-9_]+)", 36),
    "slack": ("xox[abeoprs]-([0-9A-Za-z-]+)", 10),
    "google": ("AIza([0-9A-Za-z_-]+)", 35),
    "stripe": ("(?:sk|rk)_(?:live|test)_([0-9A-Za-z]+)", 24),
    "jwt": (r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.([A-Za-z0-9_-]+)", 10),
    "private_key": ("-----BEGIN [A-Z ]*PRIVATE KEY----(-)", 1),
}
BITS = [
    "password", "Passwd", "secret", "TOKEN", "token", "api_key", "ApiKey", " ", "  ", ":", "=", "==", "'", '"', "AKIA", "ABCDEFGH12345678",
    "0123456789abcdef", "deadbeef", "é", "😀", "\n", "x", "token=token", "-", "f" * 30, "ghp_", "gho_" + "aB3" * 12, "xoxb-", "1234567890",
    "AIza", "k" * 35, "sk_live_", "b1" * 12, "eyJhbGci", ".", "eyJzdWIi", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "\0", "\x7f",
]


def secrets_of(text):
    out = []
    for i, (pattern, least) in enumerate(PLAIN.values()):
        out += [(m.start(), i, m.end()) for m in re.finditer(pattern, text or "") if len(m[1]) >= least]
    return sorted(out)


def test_automaton_finds_what_regexes_find():
    r = random.Random(3)
    texts = ["".join(r.choice(BITS) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    texts += [None, "", " " * 30000 + "secret" + " " * 20000 + "= abcdefgh", "a" * 100_000, "AKIA" * 20_000, "token=" * 10_000, "é" * 50_000 + "f" * 24]
    compiled = automaton.compile_rules(list(secret_scan.RULES))
    assert [rule.name for rule in secret_scan.RULES] == list(PLAIN)
    found = {i: spans for _, i, spans in secret_scan.find(pa.array(texts), compiled)}
    assert {i: found.get(i, []) for i in range(len(texts))} == {i: secrets_of(x) for i, x in enumerate(texts)}
    assert {rule for spans in found.values() for _, rule, _ in spans} == set(range(len(PLAIN)))


@pytest.mark.parametrize("scan", [64, 1000])
def test_places_do_not_depend_on_how_a_text_is_read(monkeypatch, scan):
    r = random.Random(4)
    text = "".join(r.choice(BITS) for _ in range(3000)).encode()
    compiled = automaton.compile_rules(list(secret_scan.RULES))
    codes = compiled.starts.columns[np.frombuffer(text, np.uint8)]
    whole = automaton.match_starts(codes, compiled.starts)
    monkeypatch.setattr(automaton, "SCAN_BYTES", scan)
    monkeypatch.setattr(automaton, "LEAST_STEPS", 3)
    assert all((a == b).all() for a, b in zip(whole, automaton.match_starts(codes, compiled.starts)))


@pytest.mark.parametrize("pattern", ["a(b|c)*d", "x{2,4}y", "[^a-c]z+", r"(a|ab)(c|bcd)", "a?b?c+", r"\x41\.[\]\-]", "(ab|a)*c"])
def test_patterns_mean_what_regexes_mean(pattern):
    r = random.Random(pattern)
    found = automaton.forward_automaton([automaton.Rule("r", pattern)])
    for _ in range(400):
        text = "".join(r.choice("abcdxyzA.]-") for _ in range(r.randint(0, 6)))
        state = found.firsts[0]
        for byte in text.encode():
            state = found.moves[state, found.columns[byte]]
        assert bool(found.accepts[state]) == bool(re.fullmatch(pattern, text)), text


def test_automaton_is_small_and_refuses_what_it_cannot_do():
    same = automaton.forward_automaton([automaton.Rule("r", "(ab|cb)d|(ab|cb)e")])
    assert len(same.moves) == 5  # first, after a or c, after b, complete, dead
    for bad in ("a*", "ab|abcd", "a.b", "(a", "é", r"\d"):
        with pytest.raises(ValueError):
            automaton.compile_rules([automaton.Rule("r", bad)])


def test_scan_redact_and_report(spark):
    odd = "AKIA" + "A" * 16
    rows = [
        (1, f"é password = hunter22, {odd}", 5, "x"), (1, f"é password = hunter22, {odd}", 5, "x"), (None, "f" * 24, None, None),
        (3, None, 1, "y"), (4, "", 1, "y"), (5, "secret: token: abcdefgh", 1, "y"), (6, f"token={odd}!", 2, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int, row string")
    got = secret_scan.scan(docs).collect()
    spans = lambda x: [(s.start, list(PLAIN).index(s.kind), s.stop) for s in x]
    assert sorted(((r.row.doc_id or 0), r.row.spans or 0, spans(r.spans)) for r in got) == sorted(((x[0] or 0), x[2] or 0, secrets_of(x[1])) for x in rows)
    clean = {r.doc_id: (r.text, r.spans, r.row) for r in secret_scan.redact(docs).collect()}
    assert clean[1] == ("é [assign], [access]", 5, "x") and clean[6] == ("[assign]!", 2, None) and clean[3] == (None, 1, "y")
    assert clean[None] == ("[hex]", None, None) and clean[5] == rows[5][1:]
    for r in secret_scan.report(docs).collect():
        mine = secrets_of(next(x[1] for x in rows if x[0] == r.doc_id))
        text = ",".join(f"{list(PLAIN)[k]}:{a}:{b}" for a, k, b in mine)
        assert r.spans == text and r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[1] == k for x in mine) for k in range(3))
    assert secret_scan.report(docs.limit(0)).count() == 0 == secret_scan.redact(docs.limit(0)).count()


# ---------------------------------------------------------------- conversations


def rebuilt(rows):
    digest = lambda x: hashlib.sha256(f"{len((x[2] or '').encode())}:{x[2] or ''}{x[3] or ''}".encode()).hexdigest()
    turns = defaultdict(list)
    for x in rows:
        if x[0] is not None:
            turns[x[0]].append(x)
    own = {c: sorted(v, key=lambda x: (x[1] is not None, x[1] or 0, digest(x))) for c, v in turns.items()}
    own = {c: [(x[2] or "", x[3] or "") for x in v] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def plain_trie(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    out = []
    saved, leaves = {}, {}
    for k in sorted(members, key=len, reverse=True):
        saved[k] = (len(members[k]) - 1) * len(k[-1][1] if k else "") + sum(saved[x] for x in children[k])
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        ends = ",".join(str(c) for c in members[k] if len(convs[c]) == len(k))
        up = min(members[k[:-1]]) if k else None
        out.append((min(members[k]), len(k), up, len(members[k]), len(children[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("parts", [100_000, 40])
def test_trie_like_plain(spark, monkeypatch, parts):
    monkeypatch.setattr(conversation_trie, "PART_TURNS", parts)
    monkeypatch.setattr(conversation_trie, "BATCH", 3)
    monkeypatch.setattr(conversation_trie, "BLOCK", 8)
    r = random.Random(parts)
    rows = []
    for c in [*range(0, 330), 400, -1, -250]:
        turns = [(c, t if r.random() < 0.97 else None, r.choice(["user", "assistant", None]) if r.random() < 0.2 else "user", r.choice("aé") * r.randint(1, 2)) for t in range(r.randint(1, 9))]
        if c % 3 == 0:  # many the same, of many lengths
            turns = [(c, t, "user", "same") for t in range(7 + c % 2)]
        rows += turns
    rows += [(5, 0, "user", "tie"), (5, 0, "user", "tie"), (None, 0, "user", "x"), (7, 1, None, None), (8, 0, "user", "x" * 5000)]
    r.shuffle(rows)
    table = spark.createDataFrame([(*x, 1, "k") for x in rows], "conv_id long, turn long, role string, text string, depth int, key string")
    got = conversation_trie.report(table.repartition(3)).select(*COLUMNS).collect()
    assert sorted((tuple(x) for x in got), key=str) == plain_trie(rows)


def test_trie_of_nothing_and_of_one_turn(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_trie.report(empty).count() == 0
    for rows in ([(3, None, None, None)], [(c, 0, "user", "all the same") for c in range(50)], [(c, 0, "user", str(c)) for c in range(300, 340)]):
        got = conversation_trie.report(spark.createDataFrame(rows, empty.schema)).select(*COLUMNS).collect()
        assert sorted((tuple(x) for x in got), key=str) == plain_trie(rows)


def test_z_fast_trie_finds_exit_nodes():
    assert [conversation_trie.two_fattest(a, b) for a, b in ((0, 1), (0, 9), (4, 7), (8, 9), (5, 5 + 1))] == [1, 8, 6, 9, 6]
    r = random.Random(9)
    make = lambda: b"".join(r.choice((b"a", b"b")) * conversation_trie.WIDTH for _ in range(r.choice((0, 1, 3, 9, 30))))
    words = [make() for _ in range(300)] + [b"a" * 16 * n for n in range(60)]
    words = list(dict.fromkeys(words))
    trie, seen = conversation_trie.ZFastTrie(), []
    for i in range(0, len(words), 7):
        batch = words[i : i + 7]
        for word in batch:  # before they are inserted
            keys = conversation_trie.prefix_keys(word)
            common = max((next((j for j in range(min(len(x), len(word)) // 16) if x[16 * j : 16 * j + 16] != word[16 * j : 16 * j + 16]), min(len(x), len(word)) // 16) for x in seen), default=0)
            node, depth = trie.exit(keys)
            assert depth == common and trie.depth[node] <= depth and trie.keys[node][trie.depth[node]] == keys[trie.depth[node]]
        ends = trie.insert([(conversation_trie.prefix_keys(w), None) for w in batch])
        assert [trie.depth[x] for x in ends] == [len(w) // 16 for w in batch]
        seen += batch
    for node in range(1, len(trie.depth)):  # handles are two-fattest in their edges, and no others are left
        handle = trie.keys[node][conversation_trie.two_fattest(trie.above(node), trie.depth[node])]
        assert trie.handles[handle] == node and trie.above(node) < trie.depth[node]
    assert len(trie.handles) == len(trie.depth) - 1 <= 2 * len(words)


# ---------------------------------------------------------------- filters


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first, fails = {}, []
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = {"A"} if len(words) < 50 else set()
        bad |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        bad |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else set()
        bad |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        bad |= {"E"} if i is not None and i > first.get(text, i) else set()
        fails.append((source or "", bad, i in good, i in toxic))
    out = {}
    for part in {x[0] for x in fails}:
        mine = [x for x in fails if x[0] == part]
        share = defaultdict(int)
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                earlier = sum(letter in x[1] for x in mine) - len(gone)
                left = [x for x in left if letter not in x[1]]
                share[letter] += len(gone)
                alone = sum(x[1] == {letter} for x in mine)
                out[part, "".join(order), step] = [len(left), len(gone), earlier, alone, sum(x[2] for x in gone), sum(x[3] for x in gone), letter]
        for key, row in out.items():
            if key[0] == part:
                row[6] = share[row[6]]
    return out


def test_filter_audit_like_plain(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdeXY#é") for _ in range(r.randint(1, 4)))
    texts = [" ".join(word() for _ in range(r.choice((10, 60, 90)))) for _ in range(25)] + ["", None, " \n", "lower " * 60, "\x85 \x1c"]
    texts += [" ".join(f"w{i}" for i in range(70))] * 2
    docs = [(i if r.random() < 0.95 else None, r.choice(texts), r.choice(["a", "b", None])) for i in range(160)]
    docs += docs[:5]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 200, 2)] + [(4, 1, 1), (None, 1, 1)]
    table = spark.createDataFrame([(*x, True, 7) for x in docs], "doc_id long, text string, source string, good boolean, part int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(table.repartition(3), marks).collect()
    fields = (*filter_audit.FIELDS, "shapley")
    assert {(x.part, x.filter_order, x.step): [x[f] for f in fields] for x in got} == plain_audit(docs, labels)
    assert len(got) == 3 * 600 and filter_audit.audit(table.limit(0), marks).count() == 0
    without = filter_audit.audit(table.where("source = 'a'"), marks.limit(0)).collect()
    assert sum(x.good_lost + x.toxic_lost for x in without) == 0 and len(without) == 600


def test_filter_audit_runs_without_python(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet") for name in ("documents", "labels"))
    plan = filter_audit.audit(docs, labels)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_audit_of_other_filters(spark):
    rows = spark.createDataFrame([("p", True, False, True, False), ("p", True, True, False, True)], "part string, x boolean, y boolean, good boolean, toxic boolean")
    got = filter_audit.interactions(filter_audit.cells(rows, ["x", "y"]), ["x", "y"]).collect()
    assert {(x.filter_order, x.step): (x.kept, x.removed, x.redundant, x.unique_fails, x.good_lost, x.toxic_lost, x.shapley) for x in got} == {
        ("xy", 1): (0, 2, 0, 1, 1, 1, 3), ("xy", 2): (0, 0, 1, 0, 0, 0, 1), ("yx", 1): (1, 1, 0, 0, 0, 1, 1), ("yx", 2): (0, 1, 1, 1, 1, 0, 3),
    }
