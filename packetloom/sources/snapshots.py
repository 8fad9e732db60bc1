"""Stored lists and catalogs that change as a whole: versions with one pointer.

A change writes its rows to a folder of their own and then publishes the next
version number, which names that folder. Only one writer gets a number: the other
one computes its change again from the new state. Until the number is there,
nothing has changed, whatever was written; readers keep the version they opened.
"""

import uuid

from pyspark.sql import functions as F

from packetloom.sources.shared import Exists, Store, VersionLog

TRIES = 20


class Conflict(Exception):
    """Other writers were faster each time."""


class Snapshots:
    """A table of ``schema`` at ``path``, kept as numbered versions."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.log = VersionLog(spark, f"{self.path}/_versions")

    def version(self):
        """Number of the newest version; -1 before the first one."""
        return max(self.log.versions(), default=-1)

    def read(self, version=None):
        """Rows of a version, by default of the newest; no rows before the first one."""
        version = self.version() if version is None else version
        if version < 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{self.log.read(version)['folder']}")

    def publish(self, rows, base):
        """Store ``rows`` as the version after ``base``; raises ``Conflict`` if there is one already."""
        folder = f"rows-{uuid.uuid4().hex}"
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        rows.select(*columns).write.parquet(f"{self.path}/{folder}")
        try:
            self.log.add(base + 1, {"folder": folder})
        except Exists:
            Store(self.spark, self.path).delete(f"{self.path}/{folder}")
            raise Conflict(f"{self.path} has a version {base + 1} already") from None
        return base + 1

    def update(self, change, tries=TRIES):
        """Publish ``change(rows)``; made again from the newest rows if another writer was faster."""
        for _ in range(tries):
            base = self.version()
            try:
                return self.publish(change(self.read(base)), base)
            except Conflict:
                continue
        raise Conflict(f"{self.path} changed {tries} times meanwhile")

    def expire(self, keep=100):
        """Forget all but the newest ``keep`` versions, which no reader may use any more."""
        store = Store(self.spark, self.path)
        for version in sorted(self.log.versions())[:-keep]:
            store.delete(f"{self.path}/{self.log.read(version)['folder']}")
            self.log.drop(version)
