"""Folders of very many small files, listed and opened by tasks.

Spark lists files on the driver, which then holds some kilobytes for each of them
in its index, its splits and its tasks. Here a folder is listed by one task, the
names are dealt to even tasks, and these open the files; the driver counts only.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import batched
from json import detect_encoding
from typing import NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.sources import tables

#: Files that Spark lists itself.
LISTED = 50_000
LISTING_DDL = "source_file string, length bigint"
#: Bytes of text and number of files in a batch of rows.
BATCH_BYTES, BATCH_FILES = 8 << 20, 4096


class Crowd(NamedTuple):
    """Folders, (path, URI), whose files tasks are to list; a pattern of their names; the tasks that open them."""

    folders: list[tuple[str, str]]
    names: str
    tasks: int


def crowd(spark: SparkSession, folders: Iterable[str], name: str, *, flat: bool = False) -> Crowd | None:
    """The files of a name like ``movie_id=*.json`` in the folders, if they are more than ``LISTED``.

    None where Spark is to list them: if they are fewer, if they are not in a mounted
    file system, which any task can list, if the name is more than ``*`` and ``?`` or may be
    of a compressed file, and with ``flat`` if there are folders among them.
    """
    if not name.endswith(".json") or set(name) & set("[]{}\\") or name[0] in "_.*?":
        return None
    names = re.escape(name).replace(r"\*", ".*").replace(r"\?", ".")
    like, found, count, size = re.compile(names).fullmatch, [], 0, 0
    for folder in folders:
        path, files = tables._folder(spark, folder)
        if files.getUri().getScheme() != "file":
            return None
        at = files.makeQualified(path).toUri()
        found.append((at.getPath(), f"file:{at.getRawPath()}"))
        try:
            with os.scandir(at.getPath()) as entries:
                for entry in entries:
                    if flat and entry.is_dir():
                        return None
                    if like(entry.name):
                        count, size = count + 1, size + entry.stat().st_size
        except (FileNotFoundError, NotADirectoryError):
            return None
    return Crowd(found, names, tables.tasks_for(spark, size, count)) if count > LISTED else None


def listing(spark: SparkSession, files: Crowd) -> DataFrame:
    """(source_file, length) of each file that is not empty, named as a scan names it in ``_metadata.file_path``. None is opened."""
    names = files.names
    # What Java leaves as it is in a path.
    odd = r"[^A-Za-z0-9_\-!.~'()*,;:$&+=@/\x80-\U0010ffff]|[\x80-\x9f]|\s"

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        like, escape = re.compile(names).fullmatch, re.compile(odd)
        for batch in batches:
            for folder, uri in zip(batch["path"].to_pylist(), batch["uri"].to_pylist(), strict=True):
                with os.scandir(folder) as entries:
                    sizes = ((e.name, e.stat().st_size) for e in entries if like(e.name) and e.is_file())
                    for some in batched((s for s in sizes if s[1]), 10_000):
                        paths = [f"{uri}/{escape.sub(lambda m: quote(m[0], safe=''), name)}" for name, _ in some]
                        yield pa.RecordBatch.from_pydict({"source_file": paths, "length": pa.array([s[1] for s in some], pa.int64())})

    return spark.createDataFrame(files.folders, "path string, uri string").mapInArrow(look, LISTING_DDL)


def contents(listed: DataFrame, tasks: int, *, text: bool = False) -> DataFrame:
    """(source_file, content) of listed files, opened in so many even tasks.

    The content is a string of the file's bytes, or with ``text`` of its text, which
    may be in any encoding that JSON comes in.
    """
    bytes_, files_ = BATCH_BYTES, BATCH_FILES

    def open_files(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple[str, bytes]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"source_file": pa.array([r[0] for r in rows], pa.string()), "content": pa.array([r[1] for r in rows], pa.binary())})

        rows, size = [], 0
        for batch in batches:
            for name in batch["source_file"].to_pylist():
                with open(unquote(name.removeprefix("file:")), "rb") as file:
                    content = file.read()
                if text and (coded := detect_encoding(content)) != "utf-8":
                    content = content.decode(coded, "replace").encode()
                rows.append((name, content))
                size += len(content)
                if size > bytes_ or len(rows) >= files_:
                    yield packed(rows)
                    rows, size = [], 0
        if rows:
            yield packed(rows)

    dealt = listed.select("source_file").repartition(tasks, "source_file")
    opened = dealt.mapInArrow(open_files, "source_file string, content binary")
    return opened.withColumn("content", F.col("content").cast("string"))
