"""A versioned pointer in shared storage: numbered JSON documents in one folder,
of which the highest complete one is current.

A version is written to a file of another name and renamed, so readers see it
whole or not at all; its number is claimed first (a file that only one writer can
create), so two writers publish two versions.  Tables that a version names are
never changed afterwards.  Everything goes through the Hadoop file system, so the
folder may lie in any storage the cluster shares.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

#: Versions that others may still read are kept this long after they are replaced.
KEEP_SECONDS = 24 * 3600


class Files:
    """The few file operations needed, on any Hadoop path."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        p, fs = self.at(path)
        return bool(fs.exists(p))

    def names(self, folder: str) -> list[str]:
        p, fs = self.at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def listing(self, path: str) -> list[list]:
        """[name, bytes, modification time] of every file under a path."""
        p, fs = self.at(path)
        found, files = [], fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            if not f.getPath().getName().startswith(("_", ".")):
                found.append([f.getPath().toString(), f.getLen(), f.getModificationTime()])
        return sorted(found)

    def read(self, path: str) -> str:
        p, fs = self.at(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False if there is one."""
        p, fs = self.at(path)
        try:
            out = fs.create(p, False)
        except Exception:
            if fs.exists(p):
                return False
            raise
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        return True

    def rename(self, old: str, new: str) -> None:
        (a, fs), (b, _) = self.at(old), self.at(new)
        if not fs.rename(a, b):
            raise OSError(f"cannot rename {old} to {new}")

    def delete(self, path: str) -> None:
        p, fs = self.at(path)
        fs.delete(p, True)


class Versions:
    """The versions in one folder: ``{"content": ..., "at": seconds}``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.files, self.folder = Files(spark), folder.rstrip("/")

    def _path(self, n: int, kind: str = "version") -> str:
        return f"{self.folder}/{kind}-{n:010d}.json"

    def _numbers(self, kind: str = "version") -> list[int]:
        return [int(name.split("-")[1][:10]) for name in self.files.names(self.folder) if name.startswith(f"{kind}-")]

    def latest(self) -> tuple[int, dict]:
        """(number, content) of the current version; (0, {}) without one."""
        n = max(self._numbers(), default=0)
        return (n, json.loads(self.files.read(self._path(n)))["content"]) if n else (0, {})

    def publish(self, content) -> int:
        """Make ``content`` (or what a function of the current content returns)
        current; its number.  A function is called after the number is claimed, so
        it sees what others published before."""
        n = max([*self._numbers(), *self._numbers("claim")], default=0) + 1
        while not self.files.create(self._path(n, "claim"), ""):
            n += 1
        if callable(content):
            content = content(self.latest()[1])
        draft = f"{self.folder}/draft-{uuid.uuid4().hex}.json"
        self.files.create(draft, json.dumps({"content": content, "at": time.time()}))
        self.files.rename(draft, self._path(n))
        return n

    def retire(self, keep_seconds: float = KEEP_SECONDS) -> list[dict]:
        """Remove all versions that were replaced more than ``keep_seconds`` ago; the
        contents of the removed ones."""
        numbers, gone = sorted(self._numbers()), []
        for n, after in zip(numbers, numbers[1:]):
            if time.time() - json.loads(self.files.read(self._path(after)))["at"] < keep_seconds:
                break
            gone.append(json.loads(self.files.read(self._path(n)))["content"])
            self.files.delete(self._path(n))
            self.files.delete(self._path(n, "claim"))
        return gone
