"""Atomic commits of a folder store.

A store's folders are written once and never changed.  What the store holds is said by its newest manifest,
``manifests/v=<n>.json``.  A writer puts its folders beside the old ones and then publishes manifest n + 1 by
a rename that fails if that number exists.  So a crash before the rename leaves the old content readable,
readers see all of a commit or nothing of it, and two writers cannot take the same number: the second one
gets ``Conflict`` and commits on top of the first.  The rename is exclusive where the file system's is
(HDFS and its like, a local disk for the writers of one process); an object store needs a conditional put here.

Manifests hold folder names only, a few per period, batch or bucket.  After a commit the folders that only
manifests before the last two name are removed; ``vacuum`` removes what crashed writers left.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

from ..sources.files import (delete_path, largest_key, modified_at, path_exists, read_text, rename_if_absent, subfolders,
                             write_text)

_LOCK = threading.Lock()


class Conflict(RuntimeError):
    """Another writer published this version."""


def new_id() -> str:
    """Name of a commit's folders (never read as a number)."""
    return f"c-{uuid.uuid4().hex[:16]}"


class Manifests:
    """``folders(content)``: the folders that a manifest's content names, relative to ``root``."""

    def __init__(self, spark: SparkSession, root: str, folders: Callable[[dict], Iterable[str]]):
        self.spark, self.root, self.folders = spark, root.rstrip("/"), folders

    def _path(self, version: int) -> str:
        return f"{self.root}/manifests/v={version}.json"

    def version(self) -> int:
        return largest_key(self.spark, f"{self.root}/manifests", "v", ".json")

    def read(self, version: int) -> dict:
        return json.loads(read_text(self.spark, self._path(version)))

    def newest(self) -> tuple[int, dict]:
        """(version, content); version 0 and no content before the first commit."""
        version = self.version()
        return version, self.read(version) if version else {}

    def publish(self, version: int, content: dict) -> None:
        temporary = f"{self.root}/manifests/.{new_id()}"
        write_text(self.spark, temporary, json.dumps(content, sort_keys=True))
        with _LOCK:
            if rename_if_absent(self.spark, temporary, self._path(version)):
                return
        delete_path(self.spark, temporary)
        raise Conflict(f"version {version} of {self.root} is taken")

    def commit(self, change: Callable[[dict], dict | None], attempts: int = 20) -> tuple[int, dict]:
        """Publish ``change(newest content)``, again on top of whatever was published meanwhile.

        ``change`` returning None leaves the store as it is.
        """
        for _ in range(attempts):
            version, held = self.newest()
            content = change(held)  # a Conflict of its own ends the commit
            if content is None:
                return version, held
            try:
                self.publish(version + 1, content)
            except Conflict:
                continue
            self.retire(version + 1, content, held)
            return version + 1, content
        raise Conflict(f"{self.root}: {attempts} commits in a row were overtaken")

    def retire(self, version: int, content: dict, before: dict) -> None:
        """Remove the manifest before the last two and the folders that only it names."""
        old = version - 2
        if old < 1 or not path_exists(self.spark, self._path(old)):
            return
        gone = set(self.folders(self.read(old))) - set(self.folders(before)) - set(self.folders(content))
        delete_path(self.spark, self._path(old))
        for folder in sorted(gone):
            delete_path(self.spark, f"{self.root}/{folder}")

    def vacuum(self, parents: Iterable[str], older_than_seconds: float = 86_400) -> list[str]:
        """Remove folders right below ``parents`` that no manifest names into and that are older than the bound
        (a running writer's are younger)."""
        kept = set()
        for version in range(max(1, self.version() - 1), self.version() + 1):
            kept |= set(self.folders(self.read(version)))
        removed = []
        for parent in parents:
            for folder in subfolders(self.spark, f"{self.root}/{parent}"):
                name = folder[len(self.root) + 1:]
                named = any(k == name or k.startswith(name + "/") for k in kept)
                if not named and modified_at(self.spark, folder) <= -older_than_seconds:
                    delete_path(self.spark, folder)
                    removed.append(name)
        return removed
