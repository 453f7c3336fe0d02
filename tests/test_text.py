import random

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from helpers import books, chunks_of, words_of
from storytide.functions import text as tx
from storytide.functions.genres import genre_tags
from storytide.functions.stopwords import ENGLISH
from storytide.operators.chunking import chunk_text, create_chunks

ALPHABET = list("abcdefgh'  .,\n\t-0123ABIİKſẞéß’“ \u0085\u001c 😀") + ["n't", "'s ", "'re", "'ll ", "'d", "'ve "]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 400))) for _ in range(n)]


def test_stop_words_are_the_defaults(spark):
    assert sorted(ENGLISH) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


def test_chunks_and_words_match_a_second_statement(spark):
    texts = random_texts(300) + ["", "a", "x" * 19, "x" * 20, "x" * 21, "Isn't it's they'd we've I'll you're 'tis", "Naïve café"]
    frame = books(spark, [(str(i), t) for i, t in enumerate(texts)])
    got = {(r.book_id, r.chunk_index): r.chunk_text for r in chunk_text(frame).collect()}
    want = {(str(i), j): c for i, t in enumerate(texts) for j, c in chunks_of(t, 20)}
    assert got == want
    got = {(r.book_id, r.chunk_index): r.words for r in create_chunks(frame).collect()}
    assert got == {key: words_of(c) for key, c in want.items()}


def test_chunks_join_back_to_the_text(spark):
    texts = [t for t in random_texts(50, seed=2) if t]
    frame = chunk_text(books(spark, [(str(i), t) for i, t in enumerate(texts)]), 7)
    pieces = {}
    for row in frame.orderBy("book_id", "chunk_index").collect():
        pieces.setdefault(row.book_id, []).append(row.chunk_text)
    assert {i: "".join(p) for i, p in pieces.items()} == {str(i): t for i, t in enumerate(texts)}
    assert all(len(p) == min(7, len(texts[int(i)])) for i, p in pieces.items())


def test_null_text_gives_no_chunks(spark):
    assert chunk_text(books(spark, [("1", None), ("2", "")])).count() == 0


@pytest.mark.parametrize(
    "text, want",
    [
        ("isn't it's they'd", ["they", "would"]),
        ("Naïve café", ["caf"]),
        ("the and of", []),
        ("rock'n'roll o'clock", ["rocknroll", "oclock"]),
    ],
)
def test_word_rules(spark, text, want):
    keep_would = [w for w in ENGLISH if w not in ("would", "they")]
    frame = create_chunks(books(spark, [("1", text)]), 1, keep_would)
    assert frame.first().words == want == words_of(text, keep_would)


def test_custom_stop_words(spark):
    frame = create_chunks(books(spark, [("1", "the whale and the ship")]), 1, ("whale", "it's"))
    assert frame.first().words == ["the", "and", "the", "ship"]
    assert create_chunks(books(spark, [("1", "the whale")]), 1, ()).first().words == ["the", "whale"]


@pytest.mark.parametrize("length, want", [(1, 5), (800, 5), (5999, 5), (6000, 6), (9999, 9), (10000, 20)])
def test_adaptive_chunks(spark, length, want):
    frame = books(spark, [("1", "x" * length)])
    assert frame.select(tx.adaptive_chunks(F.col("text")).alias("n")).first().n == want


def test_markers(spark):
    text = "a *** START OF X\nY ***body*** END OF\nX *** z *** START again *** tail *** END"
    frame = books(spark, [("1", text)])
    assert frame.select(tx.strip_markers(F.col("text")).alias("t")).first().t == "a body z  tail *** END"


def test_decoding_drops_invalid_bytes(spark):
    frame = spark.createDataFrame([(bytearray(b"abc\xffdef \xc3\xa9"),)], "content binary")
    assert frame.select(tx.decode_utf8(F.col("content")).alias("t")).first().t == "abcdef é"
    frame = spark.createDataFrame([("a\r\nb\rc\n",)], "t string")
    assert frame.select(tx.fold_newlines(F.col("t")).alias("t")).first().t == "a\nb\nc\n"


def test_decoding_keeps_replacement_characters_of_the_text(spark):
    own = "a\ufffdb".encode()
    rows = [(own,), (own + b"\xff!",), (b"\xe2\x82" + own,), (None,)]
    got = [r.t for r in spark.createDataFrame(rows, "content binary").select(tx.decode_utf8(F.col("content")).alias("t")).collect()]
    assert got == ["a\ufffdb", "a\ufffdb!", "a\ufffdb", None]


def test_genre_tags(spark):
    cases = [
        (None, None, []),
        ("", "Fiction", []),
        ("Browsing: Fiction; Gothic Fiction ", "Science fiction", ["gothic fiction", "science fiction"]),
        ("A;a ; A", "Horror tales; HORROR", ["a", "horror"]),
        (None, "Detective stories;\tmystery;Juvenile historical", ["children's literature", "mystery"]),
        (None, "Historical drama; Romances; fantasy romance", ["fantasy", "historical fiction", "romance"]),
        (None, "Adventure; horror adventure", ["adventure", "horror"]),
    ]
    frame = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, bookshelves string, subjects string")
    got = {r.i: sorted(r.tags) for r in frame.select("i", genre_tags().alias("tags")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}
