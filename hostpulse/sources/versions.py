"""Versions of the stored layers: readers keep what they opened while a new build replaces it.

A build goes to a folder of its own. When it is whole, one small file, ``CURRENT``,
is replaced by one that names it; nothing that a reader has opened is touched.

    <root>/CURRENT                      name of the published version
    <root>/versions/<name>/...          its layers
    <root>/versions/<name>/MANIFEST     files and bytes of each layer, written last
    <root>/leases/<name>/<reader>       readers that have pinned it
    <root>/live/...                     what the live job appends; not versioned
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

from hostpulse.sources.files import Files
from hostpulse.sources.tables import Layers

DAY_SECONDS = 86_400


class NothingPublished(LookupError):
    """No version has been published under this root yet."""


@dataclass(frozen=True)
class Versions:
    """Published versions of the layers under one root."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"

    @property
    def _files(self) -> Files:
        return Files(self.spark)

    @property
    def _pointer(self) -> str:
        return f"{self.root}/CURRENT"

    def _folder(self, name: str) -> str:
        return f"{self.root}/versions/{name}"

    def _manifest(self, name: str) -> str:
        return f"{self._folder(name)}/MANIFEST"

    def _leases(self, name: str) -> str:
        return f"{self.root}/leases/{name}"

    def _layers(self, name: str) -> Layers:
        return Layers(self.spark, self._folder(name), self.fmt)

    @property
    def live(self) -> Layers:
        """Where the live job appends: it goes on through every rebuild of the batch layers."""
        return Layers(self.spark, f"{self.root}/live", self.fmt)

    def name(self) -> str | None:
        """The published version; one small read."""
        return self._files.read(self._pointer)

    def current(self) -> Layers:
        """The published layers. Pin them where a reader outlasts the next sweep."""
        name = self.name()
        if name is None:
            raise NothingPublished(self.root)
        return self._layers(name)

    @contextmanager
    def building(self) -> Iterator[Layers]:
        """Layers to fill; they are published if the block ends well, and removed if not."""
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        try:
            yield self._layers(name)
            self.publish(name)
        except BaseException:
            if self.name() != name:
                self._files.delete(self._folder(name))
            raise

    def publish(self, name: str) -> None:
        """Write the version's manifest, then point readers to it."""
        files = self._files
        held = {layer: files.summary(path) for layer, path in self._layers(name).paths().items()}
        told = {layer: [found.files, found.bytes] for layer, found in held.items() if found}
        files.write(self._manifest(name), json.dumps(told, sort_keys=True))
        files.write(self._pointer, name)

    def damaged(self, name: str | None = None) -> list[str]:
        """Layers of a version that no longer have the files and bytes they were published with.

        Asks the store for sums, one request a layer, and reads no data. A version
        without a manifest was never whole: all its layers count as damaged.
        """
        name = name or self.name()
        if name is None:
            raise NothingPublished(self.root)
        files, paths = self._files, self._layers(name).paths()
        text = files.read(self._manifest(name))
        if text is None:
            return sorted(paths)
        found = []
        for layer, told in json.loads(text).items():
            now = files.summary(paths[layer])
            if now is None or [now.files, now.bytes] != told:
                found.append(layer)
        return found

    @contextmanager
    def pinned(self) -> Iterator[Layers]:
        """The published layers, which no sweep removes before the block ends."""
        files = self._files
        while True:
            name = self.name()
            if name is None:
                raise NothingPublished(self.root)
            lease = f"{self._leases(name)}/{uuid.uuid4().hex}"
            files.write(lease, name)
            # A sweep takes the manifest away before it looks for leases.
            if files.exists(self._manifest(name)):
                break
            files.delete(lease)
        try:
            yield self._layers(name)
        finally:
            files.delete(lease)

    def _leased(self, name: str, lease_seconds: float) -> bool:
        files, folder = self._files, self._leases(name)
        oldest = (time.time() - lease_seconds) * 1000
        return any(files.modified(f"{folder}/{lease}") > oldest for lease in files.names(folder))

    def sweep(self, keep: int = 1, lease_seconds: float = 7 * DAY_SECONDS) -> list[str]:
        """Remove versions older than the published one, but for ``keep`` and those in use.

        A lease that is older than ``lease_seconds`` belongs to a reader that is
        gone. Folders of builds that never came to be published go as well, if they
        are as old as that. Returns the names removed.
        """
        files, now = self._files, self.name()
        names = [name for name in files.names(f"{self.root}/versions") if now and name < now]
        whole = [name for name in names if files.exists(self._manifest(name))]
        kept = set(whole[-keep:] if keep else [])
        removed = []
        for name in names:
            manifest = self._manifest(name)
            if name in kept or self._leased(name, lease_seconds):
                continue
            if name in whole:
                text = files.read(manifest)
                files.delete(manifest)
                if self._leased(name, lease_seconds):
                    files.write(manifest, text)
                    continue
            elif files.modified(self._folder(name)) > (time.time() - lease_seconds) * 1000:
                continue
            files.delete(self._folder(name))
            files.delete(self._leases(name))
            removed.append(name)
        return removed
