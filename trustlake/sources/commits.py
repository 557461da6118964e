"""Numbered commits of a table on shared storage: the greatest one counts, and two writers never write the same number."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced as a whole: written beside and then renamed over the old one in one step."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(beside)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    beside, target = fs.makeQualified(beside), fs.makeQualified(target)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), conf).rename(beside, target, options)


def get_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, whatever its name; Spark's readers pass over names that begin with a dot."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode(errors="replace")
    finally:
        stream.close()


class CommitConflict(Exception):
    """Another writer has committed what a change was worked out without."""


class Commits:
    """JSON documents below ``home/commits``, named by number.

    A document is written beside and then renamed without overwriting, which storage does as a whole or not at all, so
    readers see complete documents only and of two writers of one number the second learns of the first. Number 0 is
    written before anything else is stored; a folder with data and no commit has lost it, and reading it is refused.
    """

    def __init__(self, spark: SparkSession, home: str):
        self.spark, self.home = spark, home.rstrip("/")
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.home}/{name}")

    def _fs(self):
        return self._path("commits").getFileSystem(self.conf)

    def names(self, folder: str) -> list[str]:
        """What stands in a folder below ``home``; nothing where there is none."""
        fs, path = self._fs(), self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def latest(self) -> tuple[int, dict]:
        """The greatest number and its document; (-1, {}) where nothing was ever stored."""
        numbers = [int(n.removesuffix(".json")) for n in self.names("commits") if n.endswith(".json")]
        if not numbers:
            if any(not n.startswith((".", "_")) for n in self.names("data")):
                raise ValueError(f"{self.home} holds data and no commit")
            return -1, {}
        return max(numbers), self.at(max(numbers))

    def at(self, number: int) -> dict:
        stream = self._fs().open(self._path(f"commits/{number:020d}.json"))
        try:
            return json.loads(bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def commit(self, number: int, document: dict) -> bool:
        """Whether the document now stands under this number; not if another one did before."""
        fs, beside = self._fs(), self._path(f"commits/.{uuid.uuid4().hex}")
        out = fs.create(beside)
        out.write(bytearray(json.dumps(document).encode()))
        out.close()
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(beside).toUri(), self.conf)
        try:
            files.rename(fs.makeQualified(beside), fs.makeQualified(self._path(f"commits/{number:020d}.json")), options)
            return True
        except Py4JJavaError as e:
            fs.delete(beside, False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise

    def delete(self, name: str) -> None:
        self._fs().delete(self._path(name), True)
