"""Small file operations through Hadoop's file systems, on whatever store Spark reads and writes.

Only names, short texts and single renames go through here; rows never do. Needs a classic session
(the JVM of the driver); a remote session has none and fails.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class AlreadyThere(Exception):
    """The name to be created exists."""


class Store:
    """File operations of one session."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if it is absent."""
        fs, at = self._fs(folder), self._path(folder)
        if not fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(at))

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    def read(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Create or replace a file."""
        stream = self._fs(path).create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, source: str, target: str, replace: bool) -> None:
        """One rename; with ``replace`` in place of what is there, else failing if there is anything.
        Atomic where the store's rename is (HDFS, local disks); object stores copy."""
        options = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        kinds = self._jvm.java.lang.reflect.Array.newInstance(options.NONE.getClass(), 1)
        kinds[0] = options.OVERWRITE if replace else options.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs(target).getUri(), self._conf)
        self._fs(target).mkdirs(self._path(target).getParent())
        try:
            context.rename(self._path(source), self._path(target), kinds)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception):
                raise AlreadyThere(target) from None
            raise

    def first_lines(self, files: Sequence[str], encoding: str = "UTF-8", at_once: int = 16) -> list[str | None]:
        """The first line of each file (null if empty). A reader's buffer is all that is read of a file."""
        io = self._jvm.java.io

        def first(path: str) -> str | None:
            stream = self._fs(path).open(self._path(path))
            try:
                return io.BufferedReader(io.InputStreamReader(stream, encoding)).readLine()
            finally:
                stream.close()

        with ThreadPoolExecutor(at_once) as pool:
            return list(pool.map(first, files))

    def first_bytes(self, path: str, n: int) -> bytes:
        """The first bytes of a file."""
        stream = self._fs(path).open(self._path(path))
        try:
            return bytes(stream.readNBytes(n))
        finally:
            stream.close()
