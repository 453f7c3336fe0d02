import contextlib
import io
import random
import re
from urllib.parse import unquote

import pytest

from helpers import book_row, books, trajectories
from storytide.operators import joins
from storytide.schema import TRAJECTORY
from storytide.sources import books as src
from storytide.sources import lexicons as lex
from storytide.sources import tables


def plan_of(frame):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain()
    return out.getvalue()


def test_emotion_lexicon(spark, tmp_path):
    path = tmp_path / "emotions.txt"
    path.write_text("good\tjoy\t1\ngood\ttrust\t1\ngood\tfear\t0\nbad\tpositive\t1\nonlyword\nx\tjoy\tnotanumber\n\ny\tjoy\t1\textra\n")
    got = sorted(map(tuple, lex.load_emotion_lexicon(spark, str(path)).collect()))
    assert got == [("bad", "positive", 1), ("good", "joy", 1), ("good", "trust", 1), ("y", "joy", 1)]


def test_vad_lexicon(spark, tmp_path):
    path = tmp_path / "vad.txt"
    path.write_text("term\tvalence\tarousal\tdominance\n padded \t0.5\t-0.5\t0.25\nnovalue\nmulti word\t0.1\t0.2\t0.3\nz\tx\t1\t1\n\n")
    got = sorted(map(tuple, lex.load_vad_lexicon(spark, str(path)).collect()))
    assert got == [("multi word", 0.1, 0.2, 0.3), ("padded", 0.5, -0.5, 0.25)]


CATALOGUE = '''Etext Number,Title,Authors,Language,Bookshelves,Subjects,Other
1,"A ""quoted"", title",Ann,en,Horror,Fiction,x
2,Two,Bob,en; fr,,,x
,Nameless,Cid,en,,,x
 4,Four,,en,,,x
5,Cinq,Eve,fr,,,x
6,"Six
lines",Fay,en,,,x
'''


def test_metadata(spark, tmp_path):
    path = tmp_path / "catalogue.csv"
    path.write_text(CATALOGUE)
    english = src.load_metadata(spark, str(path))
    got = {r.book_id: (r.title, r.author) for r in english.collect()}
    assert got == {"1": ('A "quoted", title', "Ann"), " 4": ("Four", None), "6": ("Six\nlines", "Fay")}
    assert src.load_metadata(spark, str(path), None).count() == 5
    assert src.lookup_book(english, "4 ").first().title == "Four"
    assert src.lookup_book(english, "5").count() == 0


def test_books_from_files(spark, tmp_path):
    (tmp_path / "catalogue.csv").write_text(CATALOGUE)
    folder = tmp_path / "books"
    folder.mkdir()
    (folder / "1").write_bytes(b"*** START OF X ***Call me\xff Ishmael, whale*** END OF\nX ***")
    (folder / "5").write_bytes("Où est la baleine".encode())
    (folder / "77").write_bytes(b"unknown book")
    paths = (str(folder), str(tmp_path / "catalogue.csv"))
    english = src.load_and_chunk_books(spark, *paths, num_chunks=2).collect()
    assert [(r.book_id, r.title, r.chunk_index, r.words) for r in sorted(english, key=lambda r: r.chunk_index)] == [
        ("1", 'A "quoted", title', 0, ["call", "ish"]),
        ("1", 'A "quoted", title', 1, ["mael", "whale"]),
    ]
    every = src.load_and_chunk_books(spark, *paths, num_chunks=1, language=None)
    assert {r.book_id for r in every.collect()} == {"1", "5"}
    chosen = spark.createDataFrame([("5",)], "book_id string")
    picked = src.load_and_chunk_books(spark, *paths, num_chunks=1, language=None, limit=1, ids=chosen)
    assert [r.book_id for r in picked.collect()] == ["5"]
    assert {r.book_id for r in src.load_and_chunk_books(spark, *paths, num_chunks=1, language=None, limit=2).collect()} == {"1"}


@pytest.mark.parametrize("per_scan", [1, 50_000])
def test_only_listed_files_are_read(spark, tmp_path, monkeypatch, per_scan):
    monkeypatch.setattr(src, "FILES_PER_SCAN", per_scan)
    folder = tmp_path / "books"
    folder.mkdir()
    for name in ("1", "2", "a[b]*", "x y", "é{1}"):
        (folder / name).write_text(f"text of {name}")
    names = [("1", "One"), ("1", "One again"), ("a[b]*", "Odd"), ("x y", "Spaced"), ("é{1}", "Braces"), ("none", "No file")]
    metadata = spark.createDataFrame([(i, t, "A") for i, t in names], "book_id string, title string, author string")
    got = src.load_listed_books(spark, str(folder), metadata)
    assert sorted((r.title, r.text) for r in got.collect()) == sorted((t, f"text of {i}") for i, t in names[:-1])
    opened = {unquote(path.rsplit("/", 1)[1]) for path in got.inputFiles() if "/books/" in path}
    assert opened == {"1", "a[b]*", "x y", "é{1}"}
    assert "content" not in src.list_books(spark, str(folder))._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    assert src.load_listed_books(spark, str(folder), metadata.limit(0)).count() == 0
    few = spark.createDataFrame([("x y",)], "book_id string")
    assert src.load_listed_books(spark, str(folder), metadata, few).inputFiles()[0].endswith("x%20y")


def test_sink_reads_the_buckets_of_a_batch_only(spark, tmp_path):
    rng = random.Random(2)
    sink = str(tmp_path / "sink")
    tables.append_to_sink(trajectories(spark, [book_row(str(i), rng) for i in range(40)]), sink, buckets=16)
    tables.append_to_sink(trajectories(spark, [book_row(str(i), rng) for i in range(40, 50)]), sink, buckets=16)
    assert {r.book_id for r in tables.load_trajectories(spark, sink).collect()} == {str(i) for i in range(50)}
    assert tables.load_trajectories(spark, sink).schema == TRAJECTORY
    asked = spark.createDataFrame([("3",), ("44",), ("new",)], "book_id string")
    found = tables.stored_ids(spark, sink, asked, buckets=16)
    assert {"3", "44"} <= {r.book_id for r in found.collect()} and found.count() < 50
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan_of(found)) and "ReadSchema: struct<book_id:string>" in plan_of(found)
    read = {path.split("bucket=")[1].split("/")[0] for path in found.inputFiles()}
    assert len(read) <= 16


@pytest.mark.parametrize(
    ("name", "file", "want"),
    [("7", None, "7"), ("a/b\\c", None, "a_b_c"), ("text_file", "/x/my_own story.txt", "my own story"), ("text_file", None, "text_file"), ("12", "y.txt", "12")],
)
def test_export_names(name, file, want):
    assert tables.export_name(name, file) == f"recommendations_for_{want}"


def test_only_a_missing_path_counts_as_absent(spark, tmp_path):
    assert not tables.exists(spark, str(tmp_path / "nothing"))
    assert tables.exists(spark, str(tmp_path))
    with pytest.raises(Exception, match="nowhere"):
        tables.exists(spark, "nowhere://host/path")


def test_text_files(spark, tmp_path):
    (tmp_path / "my_own_story.txt").write_bytes(b"one\r\ntwo")
    row = src.load_text_files(spark, str(tmp_path)).first()
    assert (row.title, row.author, row.text) == ("my own story", "File Input", "one\ntwo")


def test_trajectory_table(spark, tmp_path):
    rng = random.Random(1)
    frame = trajectories(spark, [book_row("1", rng), book_row("2", rng, book_embedding=None)])
    path = str(tmp_path / "t")
    tables.save_trajectories(frame.drop("book_topics"), path)
    stored = tables.load_trajectories(spark, path)
    assert stored.schema.names == TRAJECTORY.names
    assert stored.where("book_topics IS NULL").count() == 2
    # A table written before a column existed is read with nulls.
    frame.select("book_id", "title", "author").write.parquet(str(tmp_path / "old"))
    assert tables.load_trajectories(spark, str(tmp_path / "old")).where("avg_joy IS NULL").count() == 2


def test_csv_export(spark, tmp_path):
    rng = random.Random(1)
    rows = [book_row("1", rng, title=' a "b", c\nd '), book_row("2", rng, author=None, emotion_trajectory=None)]
    frame = trajectories(spark, rows)
    tables.export_csv(frame, str(tmp_path / "c"))
    back = tables.import_csv(spark, str(tmp_path / "c"), TRAJECTORY)
    assert sorted(map(str, back.collect())) == sorted(map(str, frame.collect()))


def test_report(spark, tmp_path):
    report = spark.range(1).selectExpr("id AS n", "struct(1 AS a, array(1.5D) AS b) AS nested")
    tables.save_report(report, str(tmp_path / "r"))
    assert spark.read.schema(report.schema).json(str(tmp_path / "r")).collect() == report.collect()


def ids(frame):
    return sorted(r.book_id for r in frame.collect())


@pytest.mark.parametrize("max_rows", [1, 1000])
def test_choosing_books(spark, max_rows):
    frame = books(spark, [(str(i), "x") for i in range(6)])
    wanted = spark.createDataFrame([("1",), ("1",), ("4",), ("9",), (None,)], "book_id string")
    assert ids(joins.restrict_to(frame, wanted, max_rows)) == ["1", "4"]
    assert ids(joins.pending_books(frame, wanted, max_rows)) == ["0", "2", "3", "5"]


def test_metadata_join(spark, monkeypatch):
    frame = books(spark, [(str(i), "x") for i in range(4)])
    names = spark.createDataFrame([("1", "One", "A"), ("3", "Three", None)], "book_id string, title string, author string")
    for bound in (1, 1000):
        monkeypatch.setattr(joins, "MAX_METADATA_ROWS", bound)
        got = {r.book_id: (r.title, r.author, r.text) for r in joins.join_metadata(frame, names).collect()}
        assert got == {"1": ("One", "A", "x"), "3": ("Three", None, "x")}


def test_sample_and_batches(spark):
    frame = books(spark, [(str(i), "x") for i in range(500)])
    first = ids(joins.training_sample(frame, 50))
    assert len(first) == 50 and first == ids(joins.training_sample(frame.repartition(7), 50))
    assert first != ids(joins.training_sample(frame, 50, seed=1))
    sizes = [r["count"] for r in joins.assign_batches(frame, 5).groupBy("batch").count().collect()]
    assert len(sizes) == 5 and sum(sizes) == 500 and min(sizes) > 60


def test_small_scans_are_spread(spark, tmp_path):
    path = str(tmp_path / "b")
    books(spark, [(str(i), "x") for i in range(9)]).coalesce(1).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert src.spread_small_scan(spark.read.parquet(path)).rdd.getNumPartitions() == 2 * cores
    wide = spark.range(100, numPartitions=cores + 1)
    assert src.spread_small_scan(wide, "id") is wide




@pytest.mark.parametrize("held", [1, 1 << 24])
def test_many_files_are_listed_and_read_by_tasks(spark, tmp_path, monkeypatch, held):
    """The driver is told no path, and the same files are found as by Spark's listing."""
    from storytide.sources import files as file_tasks

    monkeypatch.setattr(src, "FILES_TOLD", 3)
    monkeypatch.setattr(file_tasks, "HELD_BYTES", held)
    folder = tmp_path / "my books"
    for name in ("top", "a/1", "a/deep/x y", "a/deep/é{1}", "b/2%20", "b/empty", "b/_hidden", "b/.dot", "_no/3", "b/_k=v", "c/a[b]*"):
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(b"" if name == "b/empty" else f"text of {name}\r\n".encode())
    every = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(folder))
    listed = src.list_books(spark, str(folder))
    assert sorted(r.path for r in listed.collect()) == sorted(r.path for r in every.select("path").collect())
    names = spark.createDataFrame([(r.book_id, t, None) for r in listed.collect() for t in ("T", "U")], "book_id string, title string, author string")
    got = src.load_listed_books(spark, str(folder), names)
    plan = plan_of(got) + plan_of(listed)
    assert "binaryFile" not in plan and "InMemoryFileIndex(11" not in plan and "MapInArrow" in plan
    want = sorted((r.path.rsplit("/", 1)[1], t, r.content.decode()) for r in every.collect() for t in ("T", "U"))
    assert sorted((r.book_id, r.title, r.text) for r in got.collect()) == want
    (folder / "a/1").unlink()
    with pytest.raises(Exception, match="a/1"):
        got.collect()


def test_folders_that_tasks_cannot_list_are_left_to_spark(spark, tmp_path):
    for name in ("one/1", "two/2", "other/3"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    assert {r.book_id for r in src.list_books(spark, f"{tmp_path}/[ot][nw][eo]").collect()} == {"1", "2"}
    assert {r.book_id for r in src.list_books(spark, f"{tmp_path}/one/1").collect()} == {"1"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        src.list_books(spark, f"{tmp_path}/nothing")
