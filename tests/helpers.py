"""The rules of text handling, scoring and similarity once more, in plain Python."""

import math
import re

from storytide.functions.stopwords import ENGLISH
from storytide.schema import AVERAGES, BOOKS, EMOTIONS, RATIOS, TRAJECTORY

EMOTION_ROWS = [
    ("good", "joy", 1), ("good", "trust", 1), ("good", "joy", 1), ("bad", "anger", 1), ("bad", "fear", 1),
    ("bad", "positive", 1), ("storm", "fear", 1), ("storm", "surprise", 0), ("wedding", "anticipation", 1),
    ("isn", "disgust", 1), ("not", "sadness", 1), ("ox", "anger", 1),
]
VAD_ROWS = [
    ("good", 0.9, 0.1, 0.5), ("good", 0.8, 0.2, 0.5), ("bad", -0.7, 0.4, -0.2), ("storm", -0.3, 0.9, 0.1),
    ("not", -1.0, -1.0, -1.0), ("calm", 0.4, -0.8, 0.2),
]


def chunks_of(text, n):
    size = max(1, len(text) // n)
    cuts = [(i, text[i * size : len(text) if i == n - 1 else (i + 1) * size]) for i in range(n)]
    return [(i, piece) for i, piece in cuts if piece]


def words_of(text, stop_words=ENGLISH):
    text = re.sub(r"[^a-z0-9\s']", " ", text.lower())
    for ending, word in (("'s", ""), ("n't", " not"), ("'re", " are"), ("'ve", " have"), ("'ll", " will"), ("'d", " would")):
        text = re.sub(ending + r"\b", word, text)
    return [w for w in text.replace("'", "").split() if len(w) > 2 and w not in stop_words]


def score_of(words):
    pairs = {(w, e) for w, e, v in EMOTION_ROWS if v == 1}
    vad = {}
    for term, *values in sorted(VAD_ROWS, reverse=True):
        vad[term] = values
    counts = {e: sum((w, e) in pairs for w in words) for e in EMOTIONS}
    hits = [vad[w] for w in words if w in vad]
    means = [sum(h[i] for h in hits) / len(hits) if hits else 0.0 for i in range(3)]
    return (*counts.values(), *means, len(hits))


def lexicons(spark):
    from storytide.plans.corpus import Lexicons
    from storytide.schema import EMOTION_LEXICON, VAD_LEXICON

    return Lexicons(spark.createDataFrame(EMOTION_ROWS, EMOTION_LEXICON), spark.createDataFrame(VAD_ROWS, VAD_LEXICON))


def books(spark, rows):
    return spark.createDataFrame([(i, f"Title {i}", "Author", text) for i, text in rows], BOOKS)


def book_row(book_id, rng, **changes):
    ratios = [rng.random() for _ in EMOTIONS]
    row = {
        "book_id": book_id,
        "title": f"Title {book_id}",
        "author": "Author",
        **{c: rng.random() for c in AVERAGES},
        "num_chunks": 3,
        "emotion_trajectory": [[float(i), *[rng.random() for _ in EMOTIONS]] for i in range(3)],
        **{c: v / sum(ratios) for c, v in zip(RATIOS, ratios)},
        "book_embedding": [rng.uniform(-1, 1) for _ in range(6)],
        "book_topics": [rng.random() for _ in range(4)],
    }
    row.update(changes)
    return row


def trajectories(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in TRAJECTORY.names) for r in rows], TRAJECTORY)


def cosine(a, b):
    na, nb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b)) / (na * nb) if na and nb else 0.0


WEIGHTS = dict(zip(RATIOS, (1.5, 2.0, 1.5, 3.0, 3.0, 2.0, 1.5, 0.5)), avg_valence=4.0, avg_arousal=4.0, avg_dominance=4.0)


def signals_of(book, query):
    def value(row, name):
        neutral = 0.125 if name.startswith("ratio") else 0.5
        return neutral if row[name] is None else row[name]

    distance = math.sqrt(sum(((value(book, c) - value(query, c)) * w) ** 2 for c, w in WEIGHTS.items()))
    flat = [[x for p in (r["emotion_trajectory"] or []) for x in p] for r in (book, query)]
    length = max(map(len, flat))
    arcs = [f + [0.0] * (length - len(f)) for f in flat]
    one, two = book["book_embedding"], query["book_embedding"]
    embedding = 0.0
    if one and two and len(one) == len(two) and any(one) and any(two):
        embedding = (cosine(one, two) + 1) / 2
    one, two = book["book_topics"] or [], query["book_topics"] or []
    shared = min(len(one), len(two))
    return {
        "feature": 1 / (1 + distance),
        "trajectory": cosine(*arcs),
        "embedding": embedding,
        "topic": cosine(one[:shared], two[:shared]),
    }
