import random

import pytest

from pyspark.sql import functions as F
from storytide.operators import joins, ranks
from helpers import books

PLACES = {"low": (1, 4), "middle": (1, 2), "high": (3, 4), "first": (0, 1)}


@pytest.mark.parametrize("values", [[], [None], [3.0], [2.0, 1.0], [5.0, None, 1.0, 4.0], "ties", "many"])
def test_values_at_places(spark, values):
    rng = random.Random(5)
    if values == "ties":
        values = [0.5] * 700 + [rng.random() for _ in range(90)] + [None] * 9
    elif values == "many":
        values = [rng.gauss(0, 1) for _ in range(2000)]
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, i long").repartition(5)
    row = ranks.values_at(rows, "v", PLACES, ties=("i",)).first()
    known = sorted(v for v in values if v is not None)
    for name, (a, b) in PLACES.items():
        assert row[name] == (known[len(known) * a // b] if known else None), name


@pytest.mark.parametrize(("limit", "held"), [(1000, 1 << 16), (0, 1 << 16), (0, 7)])
def test_best_of_each_key(spark, monkeypatch, limit, held):
    monkeypatch.setattr(ranks, "_window_limit", lambda rows: limit)
    monkeypatch.setattr(ranks, "HELD_ROWS", held)
    rng = random.Random(6)
    rows = [(rng.choice("abc") if i % 9 else None, rng.randint(0, 5) / 4, f"n{rng.randint(0, 99)}é", i) for i in range(600)]
    frame = spark.createDataFrame(rows, "k string, score double, name string, i int").repartition(4)
    got = ranks.top_per(frame, ["k"], [F.col("score"), F.concat("name", F.lpad(F.col("i").cast("string"), 4, "0"))], 20)
    assert got.columns == ["k", "score", "name", "i", "rank"]
    found = {(r.k, r["rank"]): r.i for r in got.collect()}
    want = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], f"{r[2]}{r[3]:04}"))
        want |= {(key, place): r[3] for place, r in enumerate(mine[:20], 1)}
    assert found == want


@pytest.mark.parametrize("size", [0, 1, 7, 250, 499, 500, 900])
def test_training_sample_is_the_head_of_the_shuffled_order(spark, size):
    frame = books(spark, [(str(i % 450) if i else None, "x") for i in range(500)]).repartition(6)
    got = sorted(str(r.book_id) for r in joins.training_sample(frame, size).collect())
    want = frame.select("book_id").orderBy(joins.training_order(), "book_id").limit(size).collect()
    assert got == sorted(str(r.book_id) for r in want)


def test_no_task_gathers_the_sample(spark):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        joins.training_sample(books(spark, [(str(i), "x") for i in range(3000)]), 2900).explain()
    assert "Exchange SinglePartition" not in out.getvalue().split("TakeOrderedAndProject")[0]


def test_bits_of_a_set_of_ids():
    assert joins._filter_bits(1) == 1 << 15 and joins._filter_bits(1 << 20) == 1 << 24
    assert joins._filter_bits(10**9) == joins.MAX_FILTER_BITS
