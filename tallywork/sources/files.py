"""Small files through Hadoop's file systems, so that they may lie wherever tables may."""

from __future__ import annotations

import hashlib

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Create, read, list and remove by path."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path

    def _of(self, path: str):
        at = self._path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def exists(self, path: str) -> bool:
        files, at = self._of(path)
        return files.exists(at)

    def create(self, path: str, text: str) -> None:
        """Write a new file; one that is there already is an error."""
        files, at = self._of(path)
        out = files.create(at, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str:
        files, at = self._of(path)
        stream = files.open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_signed(self, path: str, text: str) -> None:
        """Write a new file that ends with a digest of itself."""
        self.create(path, f"{text}\n{hashlib.sha256(text.encode()).hexdigest()}\n")

    def read_signed(self, path: str) -> str | None:
        """The text of such a file; None if it is not whole."""
        try:
            text, _, digest = self.read(path).rstrip("\n").rpartition("\n")
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() == "ChecksumException":
                return None
            raise
        return text if hashlib.sha256(text.encode()).hexdigest() == digest else None

    def names(self, folder: str) -> dict[str, int]:
        """Name and length of what a folder holds; nothing if there is no such folder."""
        files, at = self._of(folder)
        if not files.exists(at):
            return {}
        return {s.getPath().getName(): s.getLen() for s in files.listStatus(at)}

    def remove(self, path: str) -> None:
        files, at = self._of(path)
        files.delete(at, True)

    def make_folder(self, path: str) -> None:
        files, at = self._of(path)
        files.mkdirs(at)

    def remove_on_exit(self, path: str) -> None:
        """Removed when the application ends."""
        files, at = self._of(path)
        files.deleteOnExit(at)

    def fingerprint(self, paths: list[str]) -> str:
        """What files there are under paths, folders or patterns: a digest of their names, lengths and times."""
        found = []
        for path in paths:
            files, at = self._of(path)
            for status in files.globStatus(at) or []:
                every = files.listFiles(status.getPath(), True)
                while every.hasNext():
                    one = every.next()
                    found.append(f"{one.getPath()} {one.getLen()} {one.getModificationTime()}")
        return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()
