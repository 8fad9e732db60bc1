"""Names in a folder that Spark reaches: existence, renames, small JSON files.

Only names and small files pass through the driver. Every store Spark can read
works, as Hadoop's own classes are called.
"""

import json
import uuid

from py4j.protocol import Py4JJavaError


class Exists(Exception):
    """The name is taken."""


class Store:
    """File operations on the store that ``folder`` is in."""

    def __init__(self, spark, folder):
        self.folder = str(folder).rstrip("/")
        self._jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        path = self._path(self.folder)
        self._fs = path.getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.makeQualified(path).toUri(), conf)

    def _path(self, name):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name):
        return self._fs.exists(self._path(name))

    def names(self, folder):
        """Names in ``folder``; none if it does not exist."""
        if not self.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(folder)))

    def delete(self, name):
        self._fs.delete(self._path(name), True)

    def rename(self, name, target):
        """Rename a file or folder; raises ``Exists`` rather than replace anything."""
        kinds = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._jvm.java.lang.reflect.Array.newInstance(kinds.NONE.getClass(), 1)
        options[0] = kinds.NONE
        try:
            self._context.rename(self._path(name), self._path(target), options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise Exists(target) from None
            raise

    def read(self, name):
        stream = self._fs.open(self._path(name))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write_new(self, name, value):
        """Write a JSON file under a name that must be free; readers see it whole or not at all."""
        folder, _, own = name.rpartition("/")
        draft = f"{folder}/.{own}-{uuid.uuid4().hex}"
        self._fs.mkdirs(self._path(folder))
        stream = self._fs.create(self._path(draft), True)
        stream.write(bytearray(json.dumps(value).encode()))
        stream.close()
        try:
            self.rename(draft, name)
        except Exists:
            self.delete(draft)
            raise


class VersionLog:
    """JSON values numbered from 0 in ``folder``; a number is given once."""

    def __init__(self, spark, folder):
        self.store, self.folder = Store(spark, folder), folder

    def _file(self, version):
        return f"{self.folder}/{version:020d}.json"

    def versions(self):
        return [int(name[:-5]) for name in self.store.names(self.folder) if name.endswith(".json") and name[0] != "."]

    def newest(self):
        """Number and value of the newest version, or (-1, None)."""
        last = max(self.versions(), default=-1)
        return last, None if last < 0 else self.store.read(self._file(last))

    def read(self, version):
        return self.store.read(self._file(version))

    def add(self, version, value):
        """Publish ``version``; raises ``Exists`` if another writer has done so."""
        self.store.write_new(self._file(version), value)

    def drop(self, version):
        self.store.delete(self._file(version))
