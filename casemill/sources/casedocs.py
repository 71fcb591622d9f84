"""``casedocs``: a folder as a partitioned source of its files' names, and their bytes.

``spark.read.format("casedocs").load(folder)`` lists the regular files directly in a folder in
``shards`` partitions. A file belongs to the shard of its stem, so a shard sees all files of a stem and
numbers them itself: no later step has to bring equal stems together. Spark's own file sources leave out
empty files and names that begin with an underscore; this one lists them like all others.

Bytes are read in a second step, ``with_bytes``, on the rows of the listing: each task opens the files
of its rows and puts the bytes behind the columns that are there already, so bytes are never part of a
join or a shuffle.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from casemill import fixed_values as V
from casemill.session import Stage

#: ``same_stem``: supported files of the folder that share the stem, the file itself included (0: not supported).
LISTING_TYPE = "path string, file_name string, length bigint, same_stem bigint"
SHARDS = 16
#: Rows in a batch of listed files; bytes after which a batch of contents goes on its way, and for one reading task.
_ROWS, _BATCH_BYTES, TASK_BYTES = 10_000, 8 << 20, 64 << 20
_SUFFIX = re.compile(r"(?s)\A.+(\.[^.]+)\Z")


def file_system(path: str):
    """The file system of a path or URI and the path in it."""
    from pyarrow import fs

    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    # In a URI signs such as blanks and # are escaped; paths from Spark have them as they are.
    scheme, rest = path.split("://", 1)
    return fs.FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/:@')}")


def _entries(folder: str) -> Iterator[tuple[str, str, int]]:
    """``path, name, length`` of the regular files in a folder."""
    from pyarrow import fs

    system, inner = file_system(folder)
    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(inner) as found:  # one entry at a time
            for entry in found:
                if entry.is_file():
                    yield f"file:{entry.path}", entry.name, entry.stat().st_size
        return
    root = folder.rstrip("/")
    for info in system.get_file_info(fs.FileSelector(inner)):
        if info.type == fs.FileType.File:
            yield f"{root}/{info.base_name}", info.base_name, info.size


def _stem(name: str) -> tuple[str, bool]:
    found = _SUFFIX.match(name)
    suffix = found[1] if found else ""
    return name[: len(name) - len(suffix)], suffix.lower() in V.SUPPORTED_EXTENSIONS


@dataclass
class Shard(InputPartition):
    number: int


class _Listing(DataSourceReader):
    def __init__(self, folder: str, shards: int):
        self._folder, self._shards = folder, shards

    def partitions(self) -> list[Shard]:
        return [Shard(k) for k in range(self._shards)]

    def read(self, shard: Shard) -> Iterator[pa.RecordBatch]:
        own, stems = [], {}
        for path, name, length in _entries(self._folder):
            stem, supported = _stem(name)
            if zlib.crc32(stem.encode("utf-8", "surrogateescape")) % self._shards != shard.number:
                continue
            counted = supported and not name.startswith(tuple(V.HIDDEN_PREFIXES))
            stems[stem] = stems.get(stem, 0) + counted
            own.append((path, name, length, stem if counted else None))
        for at in range(0, len(own), _ROWS):
            paths, names, lengths, keys = zip(*own[at : at + _ROWS])
            same = [0 if k is None else stems[k] for k in keys]
            columns = [pa.array(paths), pa.array(names), pa.array(lengths, pa.int64()), pa.array(same, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["path", "file_name", "length", "same_stem"])


class CaseDocs(DataSource):
    """Options: ``path``, and ``shards``, the number of partitions that list."""

    @classmethod
    def name(cls) -> str:
        return "casedocs"

    def schema(self) -> str:
        return LISTING_TYPE

    def reader(self, schema) -> _Listing:
        return _Listing(self.options["path"], int(self.options.get("shards", SHARDS)))


def listing(spark, folder: str, shards: int | None = None) -> DataFrame:
    """The files directly in ``folder``, listed by ``shards`` tasks; the driver only looks at the folder itself."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(root):
        raise FileNotFoundError(f"Data folder not found: {folder}")
    if not system.getFileStatus(root).isDirectory():
        raise NotADirectoryError(f"Data path is not a folder: {folder}")
    spark.dataSource.register(CaseDocs)
    whole = system.makeQualified(root).toString()
    found = spark.read.format("casedocs").option("shards", shards or max(SHARDS, spark.sparkContext.defaultParallelism)).load(whole)
    # Written, so that every later step sees one and the same listing.
    return Stage(spark).write(found)


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``content``, or what kept it from being read, to rows with ``path`` and ``load_error``."""
    for batch in batches:
        contents, errors, held, start = [], [], 0, 0
        for k, (path, error) in enumerate(zip(batch.column("path").to_pylist(), batch.column("load_error").to_pylist(), strict=True)):
            content = None
            if error is None:
                try:
                    system, inner = file_system(path)
                    with system.open_input_stream(inner, compression=None) as handle:
                        content = handle.read()
                except FileNotFoundError:
                    error = f"missing_file: {path}"
                except (OSError, ValueError) as exc:
                    error = f"unreadable: {type(exc).__name__}: {exc}"
            contents.append(content)
            errors.append(error)
            held += len(content or b"")
            if held >= _BATCH_BYTES or k == batch.num_rows - 1:
                rows = batch.slice(start, k + 1 - start)
                at = batch.schema.get_field_index("load_error")
                rows = rows.set_column(at, "load_error", pa.array(errors, pa.string()))
                yield rows.append_column("content", pa.array(contents, pa.binary()))
                contents, errors, held, start = [], [], 0, k + 1


def with_bytes(files: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``files`` (``path, length, load_error`` and more) with ``content``.

    The narrow rows are dealt out first, to as many tasks as the bytes ask for; rows with a
    ``load_error`` are not opened.
    """
    spark = files.sparkSession
    total = files.agg(F.sum(F.when(F.col("load_error").isNull(), F.col("length")))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema) + ", content binary"
    return files.repartition(tasks).mapInArrow(_read_files, schema)
