"""A shared folder of any Hadoop file system, for the small files of the store."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """Files and folders below a root that all executors reach. Nothing relies on renames: files are written whole, under
    new names where a reader may look at the same time."""

    def __init__(self, spark: SparkSession, root: str):
        context = spark.sparkContext
        self.hadoop, self.io = context._jvm.org.apache.hadoop.fs, context._jvm.org.apache.commons.io.IOUtils
        path = self.hadoop.Path(root)
        self.fs = path.getFileSystem(context._jsc.hadoopConfiguration())
        self.root = self.fs.makeQualified(path).toString().rstrip("/")

    def name(self, *names: str) -> str:
        return "/".join((self.root, *names))

    def path(self, *names: str):
        return self.hadoop.Path(self.name(*names))

    def exists(self, *names: str) -> bool:
        return self.fs.exists(self.path(*names))

    def make(self, *names: str) -> None:
        self.fs.mkdirs(self.path(*names))

    def write(self, text: str, *names: str) -> None:
        out = self.fs.create(self.path(*names), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, *names: str) -> str | None:
        """A file's text, None if it isn't there."""
        if not self.exists(*names):
            return None
        stream = self.fs.open(self.path(*names))
        try:
            return self.io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def list(self, *names: str) -> list[str]:
        """The names in a folder in their order; none if it isn't there."""
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(*names))) if self.exists(*names) else []

    def delete(self, *names: str) -> None:
        self.fs.delete(self.path(*names), True)
