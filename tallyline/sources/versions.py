"""Committed versions: tables that are replaced together, or not at all.

A store is a folder. Data is written into new folders under ``data`` and never changed
there. A version is one small manifest that names the folder of every entry; manifests are
numbered, and a number is taken by creating its manifest only if it is absent. A reader
picks the newest manifest once and reads what it names, so it never sees entries of two
versions; a writer that dies leaves folders that no manifest names; of two writers at once
one gets the number, and the other one goes on from the new version or, where it has read
what the other one replaced, builds again.

Entries a version does not replace keep their folder: nothing is copied.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tallyline.sources import paths

MANIFESTS, DATA, PENDING = "manifests", "data", "_pending"
ATTEMPTS = 10
KEEP_VERSIONS = 10
# A folder that no manifest names may belong to a writer at work; after a week it does not.
ORPHAN_SECONDS = 7 * 24 * 3600


class CommitConflict(RuntimeError):
    """Other writers were faster each time."""


@dataclass(frozen=True)
class Version:
    """What one manifest says. Number 0 is the empty store."""

    root: str
    number: int = 0
    entries: Mapping[str, str] = field(default_factory=dict)
    info: Mapping = field(default_factory=dict)

    def __contains__(self, name: str) -> bool:
        return name in self.entries

    def path(self, name: str) -> str:
        if name not in self.entries:
            raise FileNotFoundError(f"version {self.number} of {self.root} has no {name}")
        return paths.join(self.root, self.entries[name])

    def under(self, group: str) -> dict[str, str]:
        """Folders of the entries ``group/...`` by the rest of their names."""
        begun = group + "/"
        return {n[len(begun):]: self.path(n) for n in sorted(self.entries) if n.startswith(begun)}


@dataclass(frozen=True)
class Change:
    """Entries to put (name to folder, as :func:`new_data` names it) and to drop, facts to
    note, and the entries whose content the change was made from. A name that ends with
    ``/`` stands for all entries of the group, also for ones that come to it."""

    put: Mapping[str, str] = field(default_factory=dict)
    drop: frozenset[str] = frozenset()
    info: Mapping = field(default_factory=dict)
    reads: frozenset[str] = frozenset()

    def __bool__(self) -> bool:
        return bool(self.put or self.drop or self.info)


def _manifest(root: str, number: int) -> str:
    return paths.join(root, MANIFESTS, f"{number:012d}.json")


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions that are still there, oldest first."""
    names = paths.names(spark, paths.join(root, MANIFESTS))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def at(spark: SparkSession, root: str, number: int) -> Version:
    known = json.loads(paths.read_text(spark, _manifest(root, number)))
    return Version(root, number, known["entries"], known["info"])


def current(spark: SparkSession, root: str) -> Version:
    there = numbers(spark, root)
    return at(spark, root, there[-1]) if there else Version(root)


def new_data(root: str, label: str) -> str:
    """A folder not used before, relative to the store."""
    return f"{DATA}/{label}-{uuid.uuid4().hex}"


def publish(spark: SparkSession, base: Version, change: Change) -> Version | None:
    """The version after ``base``, or None if its number is taken."""
    entries = {n: f for n, f in base.entries.items() if n not in change.drop} | dict(change.put)
    made = Version(base.root, base.number + 1, entries, dict(base.info) | dict(change.info))
    text = json.dumps({"entries": entries, "info": made.info}, default=str, sort_keys=True)
    pending = paths.join(base.root, MANIFESTS, PENDING, uuid.uuid4().hex)
    paths.write_text(spark, pending, text)
    if paths.publish_if_absent(spark, pending, _manifest(base.root, made.number)):
        return made
    paths.delete(spark, pending)
    return None


def _differ(before: Version, after: Version, reads: Iterable[str]) -> bool:
    """Whether any of what was read has changed between two versions."""
    for name in reads:
        if name.endswith("/"):
            if before.under(name[:-1]) != after.under(name[:-1]):
                return True
        elif before.entries.get(name) != after.entries.get(name):
            return True
    return False


def commit(
    spark: SparkSession, root: str, build: Callable[[Version], Change], *, attempts: int = ATTEMPTS
) -> Version:
    """Publish what ``build`` makes of the current version. ``build`` writes its data and
    returns the change. It is called again only if another writer has replaced what it
    reads in the meantime; otherwise the same data is published on the newer version.
    A change of nothing publishes nothing."""
    base = current(spark, root)
    change = build(base)
    for _ in range(attempts):
        if not change:
            return base
        made = publish(spark, base, change)
        if made:
            return made
        newer = current(spark, root)
        if _differ(base, newer, change.reads):
            change = build(newer)
        base = newer
    raise CommitConflict(f"{attempts} attempts to commit to {root} came too late")


def expire(
    spark: SparkSession, root: str, *, keep: int = KEEP_VERSIONS, orphan_seconds: float = ORPHAN_SECONDS
) -> list[str]:
    """Forget all but the newest versions and delete the folders that no kept one names:
    at once where a forgotten version names them, else when they are old enough not to
    belong to a writer at work. Returns the deleted folders. Manifests go first, so that a
    kill in between leaves folders without a manifest and never the reverse."""
    there = numbers(spark, root)
    kept = [at(spark, root, n) for n in there[-keep:]]
    used = {f for v in kept for f in v.entries.values()}
    gone = [at(spark, root, n) for n in there[:-keep]]
    for version in gone:
        paths.delete(spark, _manifest(root, version.number))
    used_roots = {_data_root(f) for f in used}
    unused = {f for v in gone for f in v.entries.values()} - used
    deleted = []
    for folder in sorted({_data_root(f) if _data_root(f) not in used_roots else f for f in unused}):
        paths.delete(spark, paths.join(root, folder))
        deleted.append(folder)
    oldest = time.time() - orphan_seconds
    for name, modified in paths.modified(spark, paths.join(root, DATA)).items():
        folder = f"{DATA}/{name}"
        if folder not in used_roots and folder not in deleted and modified < oldest:
            paths.delete(spark, paths.join(root, folder))
            deleted.append(folder)
    return deleted


def _data_root(folder: str) -> str:
    """The folder made by :func:`new_data` that an entry's folder is, or lies in."""
    return "/".join(folder.split("/")[:2])
