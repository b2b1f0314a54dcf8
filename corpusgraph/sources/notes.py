"""Markdown note folders: listed level by level in tasks, read and written in tasks.

Spark's own file readers hide every entry whose name begins with `_`, so notes
are listed here: each round lists the folders that the last one found, one row
each, spread over the cluster, until there are none left. The driver sees
counts only. Files are then dealt out by number and size, however they lie in
folders. Plain paths and `file:` are the shared file system of all executors;
other stores are those that `pyarrow.fs` opens by their address.
"""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pfs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.functions.scale import cut, discard

#: Bytes of notes that one task reads, about, and bytes handed on at once.
TASK_BYTES = 32 << 20
BATCH_BYTES = 8 << 20

_ENTRY = "path string, folder boolean, size long, modified_at timestamp, above array<string>"
_NOTE = "path string, body string, modified_at timestamp"
_ENTRY_ARROW = pa.schema([("path", pa.string()), ("folder", pa.bool_()), ("size", pa.int64()), ("modified_at", pa.timestamp("us", "UTC")), ("above", pa.list_(pa.string()))])
_NOTE_ARROW = pa.schema([("path", pa.string()), ("body", pa.string()), ("modified_at", pa.timestamp("us", "UTC"))])


def _store(root: str) -> tuple[pfs.FileSystem, str]:
    if "://" in root or root.startswith("file:"):
        address = root if "://" in root else "file://" + root.removeprefix("file:")
        store, path = pfs.FileSystem.from_uri(address.rstrip("/"))
        return store, path
    return pfs.LocalFileSystem(), os.path.abspath(root)


def _real(store: pfs.FileSystem, path: str) -> str:
    """Where a path leads; only local stores have links."""
    return os.path.realpath(path) if isinstance(store, pfs.LocalFileSystem) else path


def _listed(root: str, ending: str):
    """Entries right below each folder: folders, and files with the ending; names that begin with a dot are skipped.

    Links are followed, but for folders that lead back to one they lie in. A folder that cannot be listed has no entries.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(root)
        for batch in batches:
            for folder, above in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    found = store.get_file_info(pfs.FileSelector(posixpath.join(base, folder) if folder else base))
                except OSError:
                    continue
                rows = []
                for info in found:
                    name = info.base_name
                    path = posixpath.join(folder, name) if folder else name
                    if name.startswith("."):
                        continue
                    if info.type == pfs.FileType.Directory:
                        real = _real(store, posixpath.join(base, path))
                        if real not in above:
                            rows.append((path, True, 0, None, [*above, real]))
                    elif info.type == pfs.FileType.File and name.endswith(ending):
                        rows.append((path, False, info.size, info.mtime, None))
                for lo in range(0, len(rows), 10_000):
                    part = zip(*rows[lo : lo + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, _ENTRY_ARROW.types, strict=True)], schema=_ENTRY_ARROW)

    return run


def list_notes(spark: SparkSession, root: str, ending: str = ".md") -> DataFrame:
    """path (relative), size, modified_at of every file below `root` with the ending, written once."""
    store, base = _store(root)
    level = spark.createDataFrame([("", [_real(store, base)])], "path string, above array<string>")
    files, spent = None, []
    while True:
        found = cut(level.mapInArrow(_listed(root, ending), _ENTRY))
        spent.append(found)
        own = found.filter("NOT folder").select("path", "size", "modified_at")
        files = own if files is None else files.unionByName(own)
        below = found.filter("folder").select("path", "above")
        count = below.count()
        if not count:
            break
        # A folder is one row of unknown size: few of them to a task.
        level = below.repartition(max(1, min(count, 4 * spark.sparkContext.defaultParallelism)))
    out = cut(files)
    for table in spent:
        discard(table)
    return out


def read_notes(spark: SparkSession, root: str, ending: str = ".md", task_bytes: int = TASK_BYTES) -> DataFrame:
    """path (relative), body, modified_at of every file below `root` with the ending.

    Entries starting with a dot are skipped, links are followed, unreadable files ignored, bytes that are not UTF-8
    replaced. There is no creation time: take it from the front matter when a note has one.
    """
    files = list_notes(spark, root, ending)
    total = files.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    parts = max(-(-(total["bytes"] or 0) // task_bytes), spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(root)
        paths, bodies, times, held = [], [], [], 0
        for batch in batches:
            for path, time in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    with store.open_input_stream(posixpath.join(base, path)) as file:
                        body = file.read()
                except OSError:
                    continue
                paths.append(path)
                bodies.append(body.decode("utf-8", "replace"))
                times.append(time.as_py())
                held += len(body)
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((paths, bodies, times), _NOTE_ARROW.types, strict=True)], schema=_NOTE_ARROW)
                    paths, bodies, times, held = [], [], [], 0
        if paths:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((paths, bodies, times), _NOTE_ARROW.types, strict=True)], schema=_NOTE_ARROW)

    return files.select("path", "modified_at").repartition(max(1, min(parts, total["n"]))).mapInArrow(run, _NOTE)


def write_notes(notes: DataFrame, root: str) -> int:
    """Write `notes(path, body)` as files below `root`, each put in place whole; returns their number.

    A task that is run again writes the same files again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(root)
        made: set[str] = set()
        for batch in batches:
            for path, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                full = posixpath.join(base, path)
                folder, name = posixpath.split(full)
                if folder not in made:
                    store.create_dir(folder)
                    made.add(folder)
                aside = posixpath.join(folder, f".{uuid.uuid4().hex}")
                with store.open_output_stream(aside) as file:
                    file.write((body or "").encode())
                store.move(aside, full)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return notes.select("path", "body").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0
