"""A log of numbered commits in a shared folder: small metadata that several jobs write at once."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

TRIES = 100


@dataclass(frozen=True)
class CommitLog:
    """One JSON file per commit, named by its number; numbers have no gaps.

    A commit is written under a hidden name first and then given its number in one step
    that fails if the number is taken, so a reader sees whole commits only and two writers
    never share a number. The step is a hard link in a local folder and a rename elsewhere.
    It needs a file system whose rename refuses an existing target atomically (HDFS does);
    a bare object store does not promise that and takes one writer at a time.
    """

    spark: SparkSession
    folder: str

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, number: int) -> str:
        return f"{self.folder.rstrip('/')}/{number:020d}.json"

    def last(self) -> int:
        """The highest number, 0 before the first commit."""
        path, fs = self._fs()
        if not fs.exists(path):
            return 0
        names = [f.getPath().getName() for f in fs.listStatus(path)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)

    def read(self, schema: str) -> DataFrame:
        """All commits, with the columns of ``schema``; a file that is no commit is an error."""
        path, fs = self._fs()
        if not fs.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("mode", "FAILFAST").json(self.folder)

    def commit(self, entry: Callable[[], dict[str, object]]) -> int:
        """Append ``entry()`` under the next number and return that number.

        ``entry`` sees the commits so far. If another writer takes the number first it is
        asked again, so what it derives from the log holds when its commit is made.
        """
        for _ in range(TRIES):
            number = self.last() + 1
            if self._claim(number, json.dumps({"commit": number, **entry()})):
                return number
        raise RuntimeError(f"no free number in {self.folder} after {TRIES} tries")

    def _claim(self, number: int, text: str) -> bool:
        path, fs = self._fs()
        fs.mkdirs(path)
        target, hidden = self._path(number), f"{self.folder.rstrip('/')}/.{uuid.uuid4().hex}"
        if fs.getScheme() == "file":
            return _link(_local(hidden), _local(target), text)
        return self._rename(hidden, target, text)

    def _rename(self, hidden: str, target: str, text: str) -> bool:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        source, goal = jvm.org.apache.hadoop.fs.Path(hidden), jvm.org.apache.hadoop.fs.Path(target)
        fs = source.getFileSystem(conf)
        out = fs.create(source, False)
        out.write(bytearray(text.encode()))
        out.close()
        options = self.spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(source, goal, options)
        except Py4JJavaError as error:
            fs.delete(source, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True


def _local(path: str) -> str:
    return unquote(urlparse(path).path) if path.startswith("file:") else path


def _link(hidden: str, target: str, text: str) -> bool:
    with open(hidden, "w", encoding="utf-8") as out:
        out.write(text)
    try:
        os.link(hidden, target)
    except FileExistsError:
        return False
    finally:
        os.unlink(hidden)
    return True
