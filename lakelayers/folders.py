"""Small files and renames in the file systems Spark is configured for."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder, reached from the driver with the session's own file systems and keys."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.path = path.rstrip("/")

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name) if name else self._root

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """What lies in the folder, in order of name; nothing if it is missing."""
        if not self.exists(name):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._at(name)))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write a small file that is there as a whole or not at all, and never replaces another."""
        draft = self._at(f"{name.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}" if "/" in name else f".{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.exists(name) or not self._fs.rename(draft, self._at(name)):
            self._fs.delete(draft, False)
            raise FileExistsError(f"{self.path}/{name}")

    def move(self, name: str, to: str) -> None:
        """Rename a file into a folder that may be missing; done before counts as done."""
        source, target = self._at(name), self._at(to)
        if self._fs.exists(source):
            self._fs.mkdirs(target.getParent())
            if not self._fs.rename(source, target):
                raise OSError(f"cannot rename {source} to {target}")
        elif not self._fs.exists(target):
            raise FileNotFoundError(source.toString())

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
