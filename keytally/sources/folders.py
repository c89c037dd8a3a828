"""The few file-system calls of stores, tables and logs, on any Hadoop file system."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folders:
    """Calls below a root, which names the file system."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, path: str) -> list[str]:
        """Names in a folder; empty if there is no such folder."""
        at = self._path(path)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def touch(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def age(self, path: str) -> float:
        """Seconds since a file was written."""
        return self._jvm.System.currentTimeMillis() / 1000 - self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def move(self, source: str, target: str) -> bool:
        """Rename a folder; False if there is no source, or the target exists already."""
        if self.exists(target) or not self.exists(source):
            return False
        return self._fs.rename(self._path(source), self._path(target))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> bool:
        """Create a file with its whole text unless it exists; True if this call did.

        Atomic where a hard link (local disk) or a rename onto an existing file (HDFS) fails.
        """
        folder, _, name = path.rpartition("/")
        made = f"{folder}/.{name}.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(made), True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                file = lambda p: self._jvm.java.io.File(self._path(p).toUri().getPath()).toPath()
                self._jvm.java.nio.file.Files.createLink(file(path), file(made))
                return True
            return self._fs.rename(self._path(made), self._path(path))
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        finally:
            self.delete(made)


def numbers(names: list[str], prefix: str) -> list[int]:
    """The numbers behind ``prefix`` in names, ascending; other names are passed over."""
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())
