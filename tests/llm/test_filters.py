"""Language id, decontamination, quality rules, license scan, quality classifier."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from storytide.llm import decontaminate, language_id, licenses, quality_classifier, quality_rules
from tests.llm import plain

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_words string"
ODD = ["", None, " \t\n", "x", "Ünï ços", "a b c " * 400, "a\n\na\nb\n a\n", "\x00a\x0bb\x0cc d", "😀 <|> 😀 ### $", "word " * 3000]


def frame(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, "en", "s", "clash") for i, t in enumerate(texts)], schema)


def collected(df, key="doc_id"):
    return {row[key]: row.asDict() for row in df.collect()}


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_on_held_out_documents(spark, documents):
    train = documents.where("doc_id % 5 != 0").select("lang", "text")
    known = language_id.learn_dictionaries(train)
    assert set(known) == {"de", "en", "es", "fr"} and all(len(x) <= language_id.DICTIONARY_BYTES for x in known.values())
    rows = language_id.predict(documents.where("doc_id % 5 = 0 and length(text) > 100"), known).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark, documents):
    known = language_id.learn_dictionaries(documents)
    got = collected(language_id.predict(frame(spark, ODD), known))
    assert [got[i]["lang_pred"] == "und" for i in range(5)] == [True, True, True, False, False]
    assert got[0]["score"] == 0.0 and got[0]["rejected"]
    nothing = language_id.learn_dictionaries(documents.limit(0))
    assert nothing == {} and {r.lang_pred for r in language_id.predict(frame(spark, ODD), nothing).collect()} == {"und"}
    assert language_id.predict(frame(spark, ODD).limit(0), known).count() == 0


def test_decontamination_like_plain(spark):
    r = random.Random(3)
    words = ["Ab", "b1", "é", "zz", "q"]
    item = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(1, item(14)), (2, item(10)), (2, item(12)), (3, "zz"), (4, "Q, é! b1"), (5, None), (6, "--"), (7, item(9))]
    texts = [*ODD, *(f"{item(20)} -- {t}; {item(5)}" for _, t in items if t), *(item(r.randint(1, 60)) for _ in range(40))]
    docs, test = frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    got = collected(decontaminate.report(docs, test))
    want = plain.hits(list(enumerate(texts)), items)
    assert {k: tuple(v[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for k, v in got.items()} == want
    clean = decontaminate.remove(docs, test)
    assert clean.columns == docs.columns
    assert {x.doc_id for x in clean.collect()} == {k for k, v in want.items() if not v[4]}
    assert decontaminate.report(docs, test.limit(0)).where("contaminated").count() == 0
    assert decontaminate.report(docs.limit(0), test).count() == 0


def test_decontamination_of_repeated_rows_and_spans(spark):
    test = spark.createDataFrame([(None, "one two three four five six seven eight nine ten"), (1, "eleven")], "item_id long, text string")
    text = "Keep, One two (three) four five six seven eight nine ten -- and eleven. End!"
    rows = [(1, text), (1, text), (1, "other"), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_hit, r.n_items) for r in decontaminate.report(docs, test).collect())
    assert got == [("1", 0, 0), ("1", 11, 1), ("1", 11, 1), ("None", 11, 1)]
    left = sorted(str(r.text) for r in decontaminate.remove(docs, test, mode="spans").collect())
    assert left == ["Keep -- and. End!"] * 3 + ["other"]


def test_counts_like_plain(spark):
    r = random.Random(1)
    texts = [*ODD, *("".join(r.choice(["a ", "b ", "c\n", "# ", "é|", "\t"]) for _ in range(r.randint(1, 300))) for _ in range(60))]
    got = quality_rules.with_counts(frame(spark, texts)).select("doc_id", "_q.*").collect()
    for row in got:
        want = plain.counts(texts[row.doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want[:5], texts[row.doc_id]


def test_quality_rules_keep_clean_and_reject_junk(spark):
    r = random.Random(2)
    clean = [" ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(r.randint(60, 200))) for _ in range(300)]
    junk = [" ".join(w + " ###$$$" for w in t.split()) for t in clean[:20]]
    rows = [(i, t, "en" if i % 3 else None, "a" if i % 2 else "b") for i, t in enumerate(clean + junk + clean[:1] * 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = collected(quality_rules.report(docs))
    assert len(got) == len(rows) and not any(v["base_failed"] for v in got.values())
    assert {k for k, v in got.items() if not v["kept"]} == set(range(300, 320))
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.report(docs.limit(0)).count() == 0
    odd = collected(quality_rules.report(frame(spark, ODD)))
    assert all(v["base_failed"] and not v["kept"] for v in odd.values())


def test_quality_rules_run_without_python(spark, documents):
    plan = quality_rules.report(documents)._jdf.queryExecution().toString()
    plan += decontaminate.report(documents, spark.read.parquet(f"{SF}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_licenses(spark):
    apache = dict(licenses.TEMPLATES)["Apache-2.0"]
    rows = [
        ("a/LICENSE", f"{apache}"),
        ("a/b/code", "nothing here"),
        ("a/b/own", "Some words come first here.\nReleased under the MIT license!\n" + "and much more text follows " * 40),
        ("c/code", "nothing here"),
        ("a/none", None),
        (None, "This work is LICENSED under the GNU General Public License, version 3.\n" + "and more words " * 90),
        ("a/d/e/LICENSE", "All rights reserved."),
        ("a/d/e/f/g", ""),
        ("ab/x", "the source of the code is under the general public version of the terms"),
    ]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, path string, text string")
    got = collected(licenses.scan(docs, F.col("path")))
    want = ["Apache-2.0", "Apache-2.0", "MIT", None, "Apache-2.0", "GPL-3.0", "proprietary", "proprietary", None]
    assert [got[i]["license"] for i in range(len(rows))] == want
    assert [got[i]["found"] for i in range(len(rows))] == ["file", "inherited", "header", None, "inherited", "header", "file", "inherited", None]
    assert licenses.scan(docs.limit(0), F.col("path")).count() == 0


def test_rows_of_one_id_and_path_have_licenses_of_their_own(spark):
    rows = [(1, "a/x", "Released under the MIT License.\n" + "more words " * 90), (1, "a/x", "nothing here"), (1, "a/x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = sorted(str(r.license) for r in licenses.scan(docs, F.col("path")).collect())
    assert got == ["MIT", "None", "None"]


def test_documents_inherit_from_directories_above(spark):
    gpl, plain_text = dict(licenses.FULL)["GPL-2.0"], "nothing here"
    rows = [(100, gpl), (110, "All rights reserved."), (101, plain_text), (111, plain_text), (112, plain_text), (205, plain_text), (None, plain_text)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: (r.license, r.path) for r in licenses.report(docs).collect()}
    assert got[100] == ("GPL-2.0", "s/en/100") and got[110] == ("proprietary", "s/en/h1/110")
    assert got[101] == ("proprietary", "s/en/h1/t10/101") and got[111][0] == "proprietary"
    assert got[205] == ("GPL-2.0", "s/en/h2/t20/205") and got[None] == ("GPL-2.0", "s/en/unknown")


def brute_force_mcd(x, floors, share, starts=60, seed=0):
    """The smallest log-determinant that concentration from random subsets finds."""
    r, n = np.random.default_rng(seed), len(x)
    h, ridge, best = int(np.ceil(share * n)), np.diag(np.square(floors)), np.inf
    for _ in range(starts):
        some = r.choice(n, 6, replace=False)
        for _ in range(40):
            c, s = x[some].mean(axis=0), np.cov(x[some].T, bias=True) + ridge
            d = np.einsum("ij,jk,ik->i", x - c, np.linalg.inv(s), x - c)
            new = np.argsort(d, kind="stable")[:h]
            if set(new) == set(some):
                break
            some = new
        best = min(best, np.linalg.slogdet(np.cov(x[some].T, bias=True) + ridge)[1])
    return best


@pytest.mark.parametrize("seed", [1, 2])
def test_estimate_has_the_smallest_determinant_of_many_starts(spark, seed):
    r = np.random.default_rng(seed)
    mix = r.normal(size=(5, 5)) * 0.3
    bulk = r.normal(size=(240, 5)) @ mix + 1
    odd = r.normal(size=(50, 5)) * 0.05 + np.array([4, -3, 3, 2, -4])  # a tight cluster far away
    x = np.round(np.concatenate([bulk, odd]), 4)
    rows = spark.createDataFrame([(0, "en", "s", *map(float, v)) for v in x], "level int, lang string, source string, x0 double, x1 double, x2 double, x3 double, x4 double")
    found = quality_rules.estimate(rows).first()
    p = np.array([[found[f"p{i}{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
    center = np.array([found[f"c{i}"] for i in range(5)])
    determinant = -2 * np.log(np.diag(p)).sum()
    assert determinant <= brute_force_mcd(x, quality_rules.FLOOR, quality_rules.SHARE) + 0.05
    distance = (((x - center) @ p.T) ** 2).sum(axis=1) / found.factor
    assert distance[:240].max() < distance[240:].min() and distance[240:].min() > quality_rules.MAX_DISTANCE


@pytest.mark.parametrize("axis", range(5))
def test_each_statistic_alone_can_reject(axis):
    ranges = (np.log(40) - np.log(5), 3.0, 1.0, np.sqrt(0.5), 1.0)  # how far each can be from clean text
    assert (ranges[axis] / quality_rules.FLOOR[axis]) ** 2 > quality_rules.MAX_DISTANCE


def test_license_headers_and_files_not_in_the_tables(spark):
    full = dict(licenses.FULL)
    code = "\nimport nothing\n" + "def apply(values): return values\n" * 60
    gnu = """# This file is part of Foo. Foo is free software; you can redistribute it and/or
# modify it under the terms of the GNU General Public License as published by
# the Free Software Foundation; either version 3 of the License, or (at your
# option) any later version.
#
# Foo is distributed in the hope that it will be useful, but WITHOUT ANY
# WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR
# A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
    changed = "".join(x for i, x in enumerate(full["GPL-2.0"].splitlines(keepends=True)) if i % 9)
    cases = [
        ("// SPDX-License-Identifier: MIT" + code, "MIT", "header"),
        ("/* Copyright (c) 2020 Foo Inc. SPDX-License-Identifier:Apache-2.0 */" + code, "Apache-2.0", "header"),
        ("# SPDX-License-Identifier: GPL-3.0-or-later" + code, "GPL-3.0", "header"),
        ("# SPDX-License-Identifier: Nobody-1.0" + code, None, None),
        ("Copyright 2020 Foo Inc. All rights reserved." + code, "proprietary", "header"),
        ("Copyright 2020 Foo Inc." + code, None, None),
        ("// Copyright 2019 A Person\n" + "\n".join("// " + x for x in full["MIT"].splitlines()[4:]) + code, "MIT", "header"),
        ("// Copyright 2019 A Person. All rights reserved.\n" + full["BSD-3-Clause"] + code, "BSD-3-Clause", "header"),
        (gnu + code, "GPL-3.0", "header"),
        ("Licensed under the GNU General Public License." + code, "GPL", "header"),
        ("Copyright (c) 2011 A Person\n" + full["MIT"], "MIT", "file"),
        (changed, "GPL-2.0", "file"),
        (full["Apache-2.0"], "Apache-2.0", "file"),
        ("// SPDX-License-Identifier: MIT\nint x;", "MIT", "header"),
    ]
    docs = spark.createDataFrame([(i, f"d{i}/x", t) for i, (t, _, _) in enumerate(cases)], "doc_id long, path string, text string")
    got = collected(licenses.scan(docs, F.col("path")))
    assert [(got[i]["license"], got[i]["found"]) for i in range(len(cases))] == [(x, y) for _, x, y in cases]


def test_license_versions_that_tie_give_the_family(spark):
    weights = licenses.Weights([("Own-1.0", "own terms one"), ("Own-2.0", "own terms two"), ("Else-1.0", "quite another")])
    pieces = spark.createDataFrame([(0, ["own", "terms"]), (1, ["own", "terms", "two"])], "k long, terms array<string>")
    got = {r.k: r.license for r in licenses.similarities(pieces, ["k"], weights).collect()}
    assert got == {0: "Own", 1: "Own-2.0"}


def test_license_files_of_any_length(spark):
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    long = "\n".join(" ".join(r.choice(words) for _ in range(12)) for _ in range(400))
    rows = [("a/LICENSE", long), ("a/code", "nothing here"), ("b/LICENSE", "Released under the MIT License.\n" * 400), ("b/code", "")]
    docs = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "doc_id long, path string, text string")
    own = collected(licenses.scan(docs, F.col("path"), licenses.Weights([*licenses.TEMPLATES, ("Own-1.0", long)])))
    assert [(own[i]["license"], own[i]["found"]) for i in range(4)] == [
        ("Own-1.0", "file"),
        ("Own-1.0", "inherited"),
        ("MIT", "file"),
        ("MIT", "inherited"),
    ]


def test_license_similarity_like_plain(spark, documents):
    weights = licenses.Weights()
    lines = sorted({x for r in documents.collect() for x in r.text.split("\n") if len(x) < 200})[:200] + [t for _, t in licenses.TEMPLATES]
    pieces = spark.createDataFrame(list(enumerate(lines)), "k long, text string").select("k", licenses.terms_of(F.col("text")).alias("terms"))
    got = {r.k: (r.license, r.score) for r in licenses.similarities(pieces, ["k"], weights).collect()}
    import math
    import re

    for k, line in enumerate(lines):
        bag = [t for t in re.findall(licenses._WORD, line.lower()) if t not in licenses.STOP_WORDS]
        v = {t: bag.count(t) * weights.idf.get(t, weights.unknown) for t in bag}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1
        best = {}
        for name, t, w in weights.vectors:
            best[name] = best.get(name, 0) + v.get(t, 0) * w / norm
        score, name = max((round(s, 6), n) for n, s in best.items())
        assert (k in got) == (score >= licenses.SIMILAR)
        if k in got:
            assert got[k][1] == pytest.approx(score, abs=2e-6)


def test_quality_classifier(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    trees = quality_classifier.train(quality_classifier.training_rows(documents, labels))
    rows = quality_classifier.score(documents, trees).join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    odd = quality_classifier.score(frame(spark, ODD), trees).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    unknown = quality_classifier.train(quality_classifier.training_rows(documents, labels.limit(0)))
    assert {r.score for r in quality_classifier.score(frame(spark, ODD), unknown).collect()} == {0.5}


def test_trees_learn_and_flat_walk_agrees():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, len(quality_classifier.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality_classifier.fit(x[:3000], y[:3000])
    assert ((trees.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    one = x[3000]
    total = trees.base
    for at in trees.roots:
        for _ in range(quality_classifier.DEPTH):
            at = trees.left[at] if one[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
        total += trees.value[at]
    assert trees.score(one[None])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_statistics_do_not_depend_on_batches():
    texts = [t or "" for t in ODD] * 3
    whole = quality_classifier.statistics(pa.array(texts))
    single = np.concatenate([quality_classifier.statistics(pa.array([t])) for t in texts])
    assert np.allclose(whole, single)
