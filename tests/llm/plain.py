"""The same operators in plain Python, for small inputs."""

import hashlib
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def repeats(docs, length=100):
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(x for x, y in zip(raw, gone) if not y)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(raw), sum(gone), runs, kept)
    return out


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def groups(docs):
    sets = {doc_id: shingles(text) for doc_id, text in docs}
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {doc_id: (len(sets[doc_id]), root(doc_id)) for doc_id in ids}


def hits(docs, items, size=10):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows = {}
    for item, text in items:
        words = find((text or "").translate(LOWER))
        k = min(size, len(words))
        for s in range(len(words) - k + 1 if k else 0):
            windows.setdefault(tuple(words[s : s + k]), set()).add(str(item))
    out = {}
    for doc_id, text in docs:
        words, hit, found = find((text or "").translate(LOWER)), set(), set()
        for k in {len(w) for w in windows}:
            for s in range(len(words) - k + 1):
                if items_of := windows.get(tuple(words[s : s + k])):
                    hit.update(range(s, s + k))
                    found |= items_of
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id] = (len(words), len(hit), len(found), digest, bool(hit))
    return out


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many, covered, seen, again = Counter(windows), set(), set(), 0
    for i, window in enumerate(windows):
        if many[window] > 1:
            covered.update((i, i + 1, i + 2))
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, again, len(covered), failed
