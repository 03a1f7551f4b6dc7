"""Small files and folder facts in whatever store Spark reads: HDFS, object stores, local."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Summary:
    """What lies below a path, without reading any of it."""

    files: int
    bytes: int


class Files:
    """Metadata operations of the session's file systems; each costs a request or two."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        store, place = self._at(path)
        return store.exists(place)

    def names(self, folder: str) -> list[str]:
        """Names of what lies directly in a folder, sorted; none if there is no such folder."""
        store, place = self._at(folder)
        if not store.exists(place):
            return []
        return sorted(status.getPath().getName() for status in store.listStatus(place))

    def modified(self, path: str) -> int:
        """Milliseconds since 1970."""
        store, place = self._at(path)
        return store.getFileStatus(place).getModificationTime()

    def set_modified(self, path: str, millis: int) -> None:
        store, place = self._at(path)
        store.setTimes(place, millis, -1)

    def summary(self, path: str) -> Summary | None:
        """Files and bytes below a path; None if it does not exist."""
        store, place = self._at(path)
        if not store.exists(place):
            return None
        found = store.getContentSummary(place)
        return Summary(found.getFileCount(), found.getLength())

    def read(self, path: str) -> str | None:
        """The text of a small file; None if it does not exist."""
        store, place = self._at(path)
        if not store.exists(place):
            return None
        stream = store.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Put a small file in place in one step, over the one that is there.

        Readers see the old text or the new one. The step is the store's own
        replacing rename, which HDFS and local file systems make atomic.
        """
        store, place = self._at(path)
        fresh = self._jvm.org.apache.hadoop.fs.Path(
            place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}"
        )
        stream = store.create(fresh)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            store.getUri(), self._conf
        )
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1
        )
        options[0] = getattr(rename, "OVERWRITE")
        context.rename(store.makeQualified(fresh), store.makeQualified(place), options)

    def delete(self, path: str) -> None:
        """Remove a file, or a folder with all that is in it."""
        store, place = self._at(path)
        store.delete(place, True)
