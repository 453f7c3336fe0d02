"""Files that tasks list and read by themselves, so that the driver is told neither names nor sizes.

Spark's own listing of a folder, and each path that a scan is told, is kept on the driver. Where Arrow knows the file
system (local and shared disks, HDFS, S3 and others), tasks ask it instead; elsewhere the caller goes on with Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storytide.workspace import kept

HELD_BYTES = 1 << 24  # of contents that a task hands on at a time


def _opener() -> Callable:
    """A function that is sent to the tasks as it stands: a path as Spark spells it to its file system and the path there."""
    known: dict = {}

    def opened(path: str):
        from pyarrow import fs

        scheme, rest = path.split(":", 1)
        if scheme == "file":
            return known.setdefault("file", fs.LocalFileSystem()), "/" + rest.lstrip("/")
        host = rest[2:].split("/", 1)[0] if rest.startswith("//") else ""
        if (scheme, host) not in known:
            known[scheme, host] = fs.FileSystem.from_uri(f"{scheme}://{host}/")[0]
        return known[scheme, host], fs.FileSystem.from_uri(f"{scheme}://{host}{quote(rest[2 + len(host):])}")[1]

    return opened


def _folder(spark: SparkSession, path: str) -> str | None:
    """The folder at ``path`` as Spark spells it, if it is one that Arrow can list."""
    if any(c in path for c in "*?[]{}\\"):
        return None  # a pattern
    try:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        whole = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(place).toString()
        system, inside = _opener()(whole)
        return whole if system.get_file_info(inside).type.name == "Directory" else None
    except Exception:  # noqa: BLE001 - whatever keeps Arrow from it, Spark may know better, or say what is wrong
        return None


def can_read(listed: DataFrame) -> bool:
    """Whether Arrow knows the file systems of all paths."""
    places = listed.select(F.regexp_extract("path", "^[^:]+:(//[^/]*)?", 0).alias("place")).distinct().limit(100).collect()
    try:
        for row in places:
            _opener()(f"{row.place}/")
    except Exception:  # noqa: BLE001 - as above
        return False
    return True


def list_files(spark: SparkSession, path: str) -> DataFrame | None:
    """``path`` of every file below a folder, or None where Spark must list it.

    A task lists the folder itself, and then each folder in it is listed by a task to its end. As in Spark's listing, names
    that begin with a dot or an underscore are left out, and so are empty files.
    """
    root = _folder(spark, path)
    if root is None:
        return None
    tasks = 3 * spark.sparkContext.defaultParallelism
    top = spark.createDataFrame([(root,)], "path string").mapInArrow(_lister(False), "path string, is_folder boolean")
    top = kept(top, "listing")
    below = top.where("is_folder").select("path").repartition(tasks, "path").mapInArrow(_lister(True), "path string, is_folder boolean")
    return top.where("NOT is_folder").select("path").unionByName(below.select("path"))


def _lister(deep: bool) -> Callable[[Iterator], Iterator]:
    opened = _opener()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        def hidden(name):
            if name.startswith(("_common_metadata", "_metadata")):
                return False
            return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)

        for batch in batches:
            waiting = batch.column("path").to_pylist()
            while waiting:
                root = waiting.pop()
                system, inside = opened(root)
                found = []
                for info in system.get_file_info(fs.FileSelector(inside)):
                    is_folder = info.type == fs.FileType.Directory
                    if not hidden(info.base_name) and (is_folder or info.size):
                        found.append((f"{root.rstrip('/')}/{info.base_name}", is_folder))
                if deep:
                    waiting.extend(name for name, is_folder in found if is_folder)
                    found = [x for x in found if not x[1]]
                for start in range(0, len(found), 1 << 16):
                    names, kinds = zip(*found[start : start + (1 << 16)])
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(kinds)], ["path", "is_folder"])

    return run


def read_files(listed: DataFrame, files_per_task: int) -> DataFrame:
    """The columns of ``listed`` with the ``content`` of the file at ``path``, read by the tasks."""
    tasks = max(4 * listed.sparkSession.sparkContext.defaultParallelism, listed.count() // files_per_task)
    schema = T.StructType([*listed.schema, T.StructField("content", T.BinaryType())])
    return listed.repartition(tasks, "path").mapInArrow(_reader(HELD_BYTES), schema)


def _reader(held_bytes: int) -> Callable[[Iterator], Iterator]:
    opened = _opener()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            contents, size, start = [], 0, 0
            for i, path in enumerate(batch.column("path").to_pylist()):
                system, inside = opened(path)
                with system.open_input_file(inside) as file:
                    contents.append(file.read())
                size += len(contents[-1])
                if size >= held_bytes or i == len(batch) - 1:
                    part = batch.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(contents, pa.binary())], [*batch.schema.names, "content"])
                    contents, size, start = [], 0, i + 1

    return run
