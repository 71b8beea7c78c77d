"""Folders and small files of whatever file system a path is on, through Hadoop's file system classes."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Operations on paths; those that are relative lie under root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def path(self, name: str = ""):
        full = name if name.startswith("/") or ":/" in name else f"{self.root}/{name}".rstrip("/")
        return self._hadoop.fs.Path(full)

    def _fs(self, name: str = ""):
        at = self.path(name)
        return at.getFileSystem(self._conf), at

    def exists(self, name: str = "") -> bool:
        fs, at = self._fs(name)
        return fs.exists(at)

    def names(self, name: str = "") -> list[tuple[str, bool, int]]:
        """(name, whether it is a folder, when it was last changed in ms) of what is in a folder; empty if there is none."""
        fs, at = self._fs(name)
        if not fs.exists(at):
            return []
        return sorted((s.getPath().getName(), s.isDirectory(), s.getModificationTime()) for s in fs.listStatus(at))

    def data(self, name: str = "") -> list[tuple[str, int]]:
        """(path, bytes) of a folder's data files, at any depth; what begins with _ or . is none, as for Spark's readers."""
        fs, at = self._fs(name)
        if not fs.exists(at):
            return []
        found, out, base = fs.listFiles(at, True), [], len(fs.makeQualified(at).toString())
        while found.hasNext():
            f = found.next()
            whole = f.getPath().toString()
            if not any(p.startswith(("_", ".")) for p in whole[base:].strip("/").split("/")):
                out.append((whole, f.getLen()))
        return sorted(out)

    def read(self, name: str) -> str:
        fs, at = self._fs(name)
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        fs, at = self._fs(name)
        out = fs.create(at, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def move(self, name: str, to: str) -> None:
        """Fails if there is something already."""
        uri = self.path(name).toUri()
        kinds = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop.fs, "Options$Rename"), 0)
        context = self._hadoop.fs.FileContext
        context = context.getFileContext(uri, self._conf) if uri.getScheme() else context.getFileContext(self._conf)
        context.rename(self.path(name), self.path(to), kinds)

    def write_new(self, name: str, text: str) -> bool:
        """Writes a whole file or nothing; False if it was there before."""
        beside = f"{name}.{id(self):x}.tmp"
        self.write(beside, text)
        try:
            self.move(beside, name)
        except Exception as e:
            self.delete(beside)
            if "FileAlreadyExists" in str(e) or self.exists(name):
                return False
            raise
        return True

    def delete(self, name: str = "") -> None:
        fs, at = self._fs(name)
        fs.delete(at, True)
