"""Folder operations on the file system Spark itself writes to."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder on any file system known to the session (HDFS, object store, local)."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._fs = self._hadoop(self.path).getFileSystem(self._conf)

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, below: str = "") -> bool:
        return self._fs.exists(self._hadoop(f"{self.path}/{below}".rstrip("/")))

    def glob(self, pattern: str) -> list[str]:
        """Paths of the matching entries, relative to this folder."""
        root = self._hadoop(self.path)
        base = self._fs.makeQualified(root).toUri().getPath().rstrip("/") + "/"
        found = self._fs.globStatus(self._hadoop(f"{self.path}/{pattern}")) or []
        return sorted(s.getPath().toUri().getPath()[len(base):] for s in found)

    def sizes(self, pattern: str) -> list[tuple[str, int]]:
        """Relative path and bytes of the matching files."""
        root = self._hadoop(self.path)
        base = self._fs.makeQualified(root).toUri().getPath().rstrip("/") + "/"
        found = self._fs.globStatus(self._hadoop(f"{self.path}/{pattern}")) or []
        return sorted((s.getPath().toUri().getPath()[len(base):], s.getLen()) for s in found if s.isFile())

    def status(self) -> list[tuple[int, int]]:
        """Bytes and time of change of this file, or of the files directly in this folder."""
        root = self._hadoop(self.path)
        if not self._fs.exists(root):
            raise FileNotFoundError(self.path)
        found = self._fs.listStatus(root)
        return [(s.getLen(), s.getModificationTime()) for s in found if s.isFile()]

    def changed_at(self, pattern: str) -> list[tuple[str, int]]:
        """Relative path and time of change (ms) of the matching entries."""
        root = self._hadoop(self.path)
        base = self._fs.makeQualified(root).toUri().getPath().rstrip("/") + "/"
        found = self._fs.globStatus(self._hadoop(f"{self.path}/{pattern}")) or []
        return sorted((s.getPath().toUri().getPath()[len(base):], s.getModificationTime()) for s in found)

    def create_once(self, name: str, text: str) -> bool:
        """Create a small file with this text; False if there is one of that name.

        It is written aside and renamed without overwriting, so it is there
        whole or not at all, and of two writers one succeeds.
        """
        target = self._hadoop(f"{self.path}/{name}")
        aside = self._hadoop(f"{self.path}/.{name}.{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        hadoop = self._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(self._fs.makeQualified(aside).toUri(), self._conf)
        none = self._gateway.new_array(hadoop.Options.Rename, 1)
        none[0] = hadoop.Options.Rename.NONE
        try:
            context.rename(self._fs.makeQualified(aside), self._fs.makeQualified(target), none)
            return True
        except Py4JJavaError as error:
            self._fs.delete(aside, False)
            if self._fs.exists(target):
                return False
            raise OSError(f"cannot create {name}") from error

    def delete(self, below: str = "") -> None:
        self._fs.delete(self._hadoop(f"{self.path}/{below}".rstrip("/")), True)

    def move_here(self, source: str, below: str, aside: str) -> None:
        """Put ``source`` at ``below``; what was there goes to ``aside`` first."""
        target = self._hadoop(f"{self.path}/{below}".rstrip("/"))
        self._fs.mkdirs(target.getParent())
        if self._fs.exists(target):
            self._fs.mkdirs(self._hadoop(aside).getParent())
            if not self._fs.rename(target, self._hadoop(aside)):
                raise OSError(f"cannot set {target} aside")
        if not self._fs.rename(self._hadoop(source), target):
            raise OSError(f"cannot publish {source} as {target}")
