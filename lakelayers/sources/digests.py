"""SHA-256 of files of any size, read block by block in tasks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK_BYTES = 4 << 20


def open_stream(path: str):
    """A byte stream over a local path or a URI that Arrow's file systems know (file, hdfs, viewfs, s3, gs, abfs)."""
    from pyarrow import fs

    uri = re.sub(r"^file:/*", "file:///", path).replace("s3a://", "s3://")
    if uri.startswith("file:///"):
        return fs.LocalFileSystem().open_input_stream(uri.removeprefix("file://"))
    system, inner = fs.FileSystem.from_uri(uri)
    return system.open_input_stream(inner)


def stream_sha256(path: str, block_bytes: int = BLOCK_BYTES) -> str:
    """The digest of one file; one block of it is held at a time."""
    digest = hashlib.sha256()
    with open_stream(path) as stream:
        while block := stream.read(block_bytes):
            digest.update(block)
    return digest.hexdigest()


def with_digest(files: DataFrame, path: str = "path", column: str = "sha256") -> DataFrame:
    """``files`` with the digest of the file that ``path`` names.

    Files are dealt to tasks one by one, as each may be large. Executors open them through Arrow, so the
    machines need Arrow's access to the store; a lost task starts its file again.
    """
    schema = files.schema.add(column, "string")
    at = files.columns.index(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                digest = pa.array([stream_sha256(one.column(at)[0].as_py())], pa.string())
                yield pa.RecordBatch.from_arrays([*one.columns, digest], [*one.schema.names, column])

    return files.repartition(path).mapInArrow(run, schema)
