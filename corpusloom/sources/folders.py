"""Files below a folder, listed and read by tasks: neither paths nor contents pass through the driver."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import fresh_path, materialise

#: Bytes of contents that a task holds at once, or one file if that is larger.
BATCH_BYTES = 16 << 20

_FOUND = "path string, length long, is_folder boolean"


def located(root: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of ``root``, the path in it, and what stands before paths in its addresses."""
    if "://" not in root and not root.startswith("file:"):
        return fs.LocalFileSystem(), root, "file:"
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/"), "file:"
    found, path = fs.FileSystem.from_uri(root)
    return found, path, root[: root.index(path)] if path in root else root.split("://")[0] + "://"


def reachable(root: str) -> bool:
    """Whether tasks can open ``root`` themselves; other stores are left to Spark's own readers."""
    try:
        located(root)
    except (pa.ArrowException, OSError, NotImplementedError):
        return False
    return True


def _list(system: fs.FileSystem, path: str) -> Iterator[fs.FileInfo]:
    """Entries of a folder, or the file itself; names that begin with ``.`` or ``_`` are not data."""
    info = system.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        yield info
    else:
        yield from (e for e in system.get_file_info(fs.FileSelector(path)) if e.base_name[:1] not in ("", ".", "_"))


def list_below(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``(path, length)`` of all files below ``root`` whose name fits ``pattern``, those of length 0 included.

    One round for each level of folders: tasks list the folders of the level, a folder a row, and what they find
    is written down, so that the driver learns only whether another level follows.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inner, before = located(path)
                found = [(before + e.path, e.size or 0, e.type == fs.FileType.Directory) for e in _list(system, inner)]
                columns = list(zip(*found)) if found else [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.bool_()))], ["path", "length", "is_folder"])

    base = fresh_path(spark, "listing")
    folders = spark.createDataFrame([(root,)], "path string")
    level, more = 0, 1
    while more:
        level += 1
        found = materialise(folders.mapInArrow(listed, _FOUND), "listing", f"{base}/level={level}")
        folders = found.where("is_folder").select("path").repartition("path")
        more = folders.limit(1).count()
    everything = spark.read.schema(_FOUND).parquet(*[f"{base}/level={i}" for i in range(1, level + 1)])
    name = F.substring_index("path", "/", -1)
    like = F.lit("^(" + re.escape(pattern).replace(r"\*", ".*").replace(r"\?", ".") + ")$")
    return everything.where(~F.col("is_folder") & F.rlike(name, like)).select("path", "length")


def with_contents(files: DataFrame) -> DataFrame:
    """``(path, length, content)`` of listed files, dealt evenly over tasks by a hash of the path."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []
        held = 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), (pa.string(), pa.int64(), pa.binary()))], ["path", "length", "content"])

        for batch in batches:
            for path, length in zip(*(c.to_pylist() for c in batch.columns)):
                if ready and held + length > BATCH_BYTES:
                    yield made()
                    ready, held = [], 0
                system, inner, _ = located(path)
                content = system.open_input_stream(inner, compression=None).read()
                ready.append((path, len(content), content))
                held += len(content)
        if ready:
            yield made()

    return files.select("path", "length").repartition("path").mapInArrow(read, "path string, length long, content binary")


def write_texts(rows: DataFrame, path: str, text: str, root: str) -> DataFrame:
    """Write the column ``text`` of each row as a file named by ``path`` below ``root``; gives ``(path, length)``.

    Files that are there are replaced, so a task that runs again leaves what the first run would have. Null texts
    are empty files. The returned table has been written down when this returns.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[str] = set()
        for batch in batches:
            sizes = []
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                system, inner, _ = located(f"{root.rstrip('/')}/{name}")
                folder = inner.rsplit("/", 1)[0]
                if folder not in known:
                    system.create_dir(folder, recursive=True)
                    known.add(folder)
                data = (body.as_py() or "").encode("utf-8")  # one text at a time is a Python string
                with system.open_output_stream(inner, compression=None) as file:
                    file.write(data)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["path", "length"])

    written = rows.select(F.col(path).alias("path"), F.col(text).alias("text")).mapInArrow(write, "path string, length long")
    return materialise(written, "written-files")
