"""Small files in any folder Spark can reach, published by one rename."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path, for tasks, of a folder named as Spark names it."""
    return fs.FileSystem.from_uri(uri if "://" in uri else re.sub(r"^(file:)?/+", "file:///", uri))


class AlreadyThere(RuntimeError):
    """Another writer published the name first."""


class Store:
    """A folder of a Hadoop file system, seen from the driver."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        conf = spark._jsc.hadoopConfiguration()
        root = self._jvm.org.apache.hadoop.fs.Path(folder)
        self._files = root.getFileSystem(conf)
        self._root = self._files.makeQualified(root)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._root.toUri(), conf
        )
        self._gateway = spark.sparkContext._gateway

    def path(self, name: str = "") -> str:
        return f"{self._root.toString()}/{name}".rstrip("/")

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.path(name))

    def names(self, folder: str = "") -> list[str]:
        """Names in a folder, sorted; none if it does not exist."""
        at = self._at(folder)
        if not self._files.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(at))

    def read_text(self, name: str) -> str:
        stream = self._files.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Writes a draft and renames it to ``name``, which must not exist yet."""
        draft = self._at(f"{name}.{uuid.uuid4().hex}.draft")
        out = self._files.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self._rename(draft, name)

    def move(self, source: str, name: str) -> None:
        """Renames a file or folder to ``name``, which must not exist yet."""
        self._rename(self._at(source), name)

    def _rename(self, source, name: str) -> None:
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._context.rename(source, self._at(name), options)
        except Exception as e:
            if self._files.exists(self._at(name)):
                raise AlreadyThere(f"{name} was published by another writer") from e
            raise
