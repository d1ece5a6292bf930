"""Byte-level access to the shared file system from driver and tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.session import qualified


def open_filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a URI.

    Callers on the driver pass paths through ``session.qualified`` first. A path
    that has no scheme then is a mounted folder.
    """
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path[len("file:"):]
        if path.startswith("s3a://"):  # the name Hadoop gives the same store
            path = "s3" + path[len("s3a"):]
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def write_text_files(df: DataFrame, root: str, path_col="path", text_col="text") -> int:
    """Write each row as a UTF-8 file below ``root``, from the tasks. Returns the file count."""

    root = qualified(df.sparkSession, root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, plain = open_filesystem(root)
        written, folders = 0, set()
        for batch in batches:
            for relative, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                target = f"{plain}/{relative}"
                folder = target.rsplit("/", 1)[0]
                if folder not in folders:
                    system.create_dir(folder, recursive=True)
                    folders.add(folder)
                with system.open_output_stream(target) as stream:
                    stream.write(text.encode("utf-8"))
                written += 1
        yield pa.RecordBatch.from_pydict({"n": [written]})

    counted = df.select(path_col, text_col).mapInArrow(write, "n bigint")
    return counted.agg(F.sum("n")).first()[0] or 0
