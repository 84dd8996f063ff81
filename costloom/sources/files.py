"""Small files and folder names, through the file system that Spark itself uses."""

from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


class Files:
    """The few calls a store needs beside Spark's readers and writers; any Hadoop file system will do."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str) -> tuple[JavaObject, JavaObject]:
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self._conf), at

    def text(self, path: str) -> str | None:
        """Content of a small file; None if there is none."""
        fs, at = self._at(path)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace_text(self, path: str, text: str) -> None:
        """Write a small file beside `path` and move it there: readers see the old content or the new one."""
        fs, at = self._at(path)
        new = self._jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}")
        stream = fs.create(new, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(fs.makeQualified(new), fs.makeQualified(at), options)

    def below(self, path: str, depth: int) -> list[str]:
        """Folders `depth` levels below `path`, relative to it; [""] for depth 0."""
        if not depth:
            return [""]
        fs, at = self._at(path)
        if not fs.exists(at):
            return []
        levels = [""]
        for _ in range(depth):
            found = []
            for rel in levels:
                for status in fs.listStatus(self._at(f"{path}/{rel}" if rel else path)[1]):
                    name = status.getPath().getName()
                    if status.isDirectory() and not name.startswith(("_", ".")):
                        found.append(f"{rel}/{name}" if rel else name)
            levels = found
        return sorted(levels)

    def names(self, path: str) -> list[str]:
        """Names directly in a folder; empty if there is no such folder."""
        fs, at = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return bool(fs.exists(at))

    def remove(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)
