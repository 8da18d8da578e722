"""Small files that are written once: the ground that ledgers and reservations stand on.

:func:`open_store` gives a folder's files as bytes, with one write that matters: :meth:`put_if_absent`
creates a file whole or not at all, and of several writers of one name exactly one succeeds. On a
mounted path this is a hard link to a finished draft, elsewhere a rename without overwriting,
which is atomic on HDFS. Object stores without such a rename cannot hold a ledger.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_DRAFT = ".draft-"  # names of files that are not finished


class MountedStore:
    """A folder below a path that the driver has mounted."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def names(self) -> list[str]:
        """Finished files, in order of their names."""
        try:
            return sorted(n for n in os.listdir(self.folder) if not n.startswith(_DRAFT))
        except FileNotFoundError:
            return []

    def read(self, name: str) -> bytes | None:
        """A file's content, None if it is not there."""
        try:
            with open(f"{self.folder}/{name}", "rb") as file:
                return file.read()
        except FileNotFoundError:
            return None

    def put_if_absent(self, name: str, data: bytes) -> bool:
        """Create a file; False, and nothing changed, if it exists."""
        os.makedirs(self.folder, exist_ok=True)
        draft = f"{self.folder}/{_DRAFT}{uuid.uuid4().hex}"
        try:
            with open(draft, "xb") as file:
                file.write(data)
                file.flush()
                os.fsync(file.fileno())
            os.link(draft, f"{self.folder}/{name}")
        except FileExistsError:
            return False
        finally:
            if os.path.exists(draft):
                os.unlink(draft)
        return True

    def delete(self, name: str) -> None:
        """Remove a file; one that is gone already is no error."""
        try:
            os.unlink(f"{self.folder}/{name}")
        except FileNotFoundError:
            pass


class HadoopStore:
    """A folder on any other file system that Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        context = spark.sparkContext
        self.jvm, self.gateway, self.folder = context._jvm, context._gateway, folder
        configuration = context._jsc.hadoopConfiguration()
        root = self._path("")
        self.fs = root.getFileSystem(configuration)
        uri = self.fs.makeQualified(root).toUri()
        self.files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, configuration)

    def _path(self, name: str) -> object:
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self) -> list[str]:
        """As :meth:`MountedStore.names`."""
        if not self.fs.exists(self._path("")):
            return []
        found = (s.getPath().getName() for s in self.fs.listStatus(self._path("")))
        return sorted(n for n in found if not n.startswith((_DRAFT, f".{_DRAFT}")))

    def read(self, name: str) -> bytes | None:
        """As :meth:`MountedStore.read`."""
        path = self._path(name)
        if not self.fs.exists(path):
            return None
        stream = self.fs.open(path)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def put_if_absent(self, name: str, data: bytes) -> bool:
        """As :meth:`MountedStore.put_if_absent`."""
        draft = self._path(f"{_DRAFT}{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(data))
        stream.close()
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        try:  # without any option a rename fails if there is a file of that name
            self.files.rename(draft, self._path(name), self.gateway.new_array(rename, 0))
        except Py4JJavaError as error:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        """As :meth:`MountedStore.delete`."""
        self.fs.delete(self._path(name), False)


# Folders are looked up often and never change their file system.
_open: dict[tuple[int, str], MountedStore | HadoopStore] = {}


def open_store(spark: SparkSession, folder: str) -> MountedStore | HadoopStore:
    """The files of a folder, which need not exist yet."""
    known = (id(spark.sparkContext), folder)
    if known not in _open:
        context = spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/"))
        fs = path.getFileSystem(context._jsc.hadoopConfiguration())
        mounted = fs.getUri().getScheme() == "file"
        _open[known] = (
            MountedStore(path.toUri().getPath()) if mounted else HadoopStore(spark, folder.rstrip("/"))
        )
    return _open[known]


def delete_tree(spark: SparkSession, path: str) -> None:
    """Remove a file or folder with all it holds; nothing there is no error."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
