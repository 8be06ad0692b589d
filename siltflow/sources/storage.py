"""Small files of the transaction log: list, read, and create-if-absent."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from typing import Protocol
from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession


class Storage(Protocol):
    def list(self, path: str) -> list[str]: ...
    def sizes(self, path: str) -> list[tuple[str, int]]: ...
    def read(self, path: str) -> str: ...
    def create(self, path: str, text: str) -> bool: ...
    def files(self, path: str) -> list[tuple[str, int]]: ...


class LocalStorage:
    """Files of the driver's machine or of a folder that it shares; creating is atomic by hard link."""

    @staticmethod
    def _at(path: str) -> str:
        return unquote(urlsplit(path).path) if path.startswith("file:") else path

    def list(self, path: str) -> list[str]:
        at = self._at(path)
        return sorted(os.listdir(at)) if os.path.isdir(at) else []

    def sizes(self, path: str) -> list[tuple[str, int]]:
        at = self._at(path)
        if not os.path.isdir(at):
            return []
        with os.scandir(at) as found:
            return sorted((e.name, e.stat().st_size) for e in found if not e.name.endswith(".tmp"))

    def read(self, path: str) -> str:
        with open(self._at(path), encoding="utf-8") as f:
            return f.read()

    def create(self, path: str, text: str) -> bool:
        """Writes path as a whole, or gives False if it is there already."""
        at = self._at(path)
        os.makedirs(os.path.dirname(at), exist_ok=True)
        temp = f"{at}.{uuid.uuid4().hex}.tmp"
        with open(temp, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(temp, at)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(temp)

    def files(self, path: str) -> list[tuple[str, int]]:
        root = self._at(path)
        found = [os.path.join(d, n) for d, _, names in os.walk(root) for n in names if n.startswith("part-")]
        return sorted((os.path.relpath(f, root), os.path.getsize(f)) for f in found)


class HadoopStorage:
    """Any file system that Spark reads. A file is written aside and renamed, which fails if the name is taken."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _fs(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self._conf)

    def list(self, path: str) -> list[str]:
        p, fs = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def sizes(self, path: str) -> list[tuple[str, int]]:
        p, fs = self._fs(path)
        return sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(p)) if fs.exists(p) else []

    def read(self, path: str) -> str:
        p, fs = self._fs(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Writes path as a whole, or gives False if it is there already."""
        p, fs = self._fs(path)
        if fs.exists(p):
            return False
        aside = self._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}.tmp")
        stream = fs.create(aside, False)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()
        try:
            return self._rename(aside, p)
        finally:
            fs.delete(aside, False)

    def _rename(self, aside, p) -> bool:
        kinds = self._jvm.org.apache.hadoop.fs.Options.Rename
        none = self._gateway.new_array(kinds, 1)
        none[0] = kinds.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self._conf).rename(aside, p, none)
        except Exception as error:
            if "FileAlreadyExistsException" in str(error):
                return False
            raise
        return True

    def files(self, path: str) -> list[tuple[str, int]]:
        p, fs = self._fs(path)
        out, it, root = [], fs.listFiles(p, True), fs.makeQualified(p).toString().rstrip("/")
        while it.hasNext():
            s = it.next()
            name = s.getPath().toString()
            if s.getPath().getName().startswith("part-"):
                out.append((name.removeprefix(root).lstrip("/"), s.getLen()))
        return sorted(out)


def storage_for(spark: SparkSession, path: str) -> Storage:
    return LocalStorage() if path.startswith(("/", "file:/")) else HadoopStorage(spark)


_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, one of our own, but on a single machine only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _OWN.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="siltflow-")
        _OWN[spark.sparkContext.applicationId] = base
    return base.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below shared_dir."""
    return f"{shared_dir(spark)}/siltflow/{name}-{uuid.uuid4().hex[:12]}"


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder that no later plan reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def dumps(actions: list[dict]) -> str:
    return "".join(json.dumps(a, separators=(",", ":"), sort_keys=True) + "\n" for a in actions)
