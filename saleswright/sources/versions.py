"""Stored outputs that change as a whole, so that a write that fails leaves the old one.

For outputs that this library reads: a folder per version, and a manifest
switched last. For exports, which others read by their path: ``swapped``.

A version is written to a folder of its own. Only when it is complete does a
small file under ``_versions``, named by its number, say which folder that is.
Readers take the highest complete number, so a write that fails half-way leaves
them on the version before. The file is created, never replaced: of two writers
of one number the second fails.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

#: Versions that stay for readers that have opened them.
KEPT = 2
_MANIFESTS = "_versions"


@dataclass(frozen=True)
class Version:
    """A committed version: its number, from 1, and its folder."""

    number: int
    folder: str


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    target, system = _path(spark, f"{path}/{_MANIFESTS}")
    if not system.exists(target):
        return []
    names = (status.getPath().getName() for status in system.listStatus(target))
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def _named(spark: SparkSession, path: str, number: int) -> str | None:
    """The folder a manifest names; None while its writer has not closed it."""
    target, system = _path(spark, f"{path}/{_MANIFESTS}/{number:09d}")
    stream = system.open(target)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return text.strip() if text.endswith("\n") else None


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest complete version; None where nothing was committed."""
    for number in _numbers(spark, path):
        if name := _named(spark, path, number):
            return Version(number, f"{path}/{name}")
    return None


def current_folder(spark: SparkSession, path: str) -> str:
    """Where to read an output: the newest version, or the path itself if it has none."""
    version = current(spark, path)
    return version.folder if version else path


@contextmanager
def new_version(spark: SparkSession, path: str, kept: int = KEPT) -> Iterator[Version]:
    """A folder to fill; it becomes the current version when the block ends well.

    If the block raises, the folder goes and readers see no change. Beyond
    ``kept`` versions, the oldest are deleted. Two writers that start from one
    version can't both end: the later one raises ``FileExistsError``.
    """
    name = f"v-{uuid.uuid4().hex}"
    before = _numbers(spark, path)
    version = Version((before[0] if before else 0) + 1, f"{path}/{name}")
    folder, system = _path(spark, version.folder)
    try:
        yield version
        _commit(spark, path, version.number, name)
    except BaseException:
        system.delete(folder, True)
        raise
    for number in _numbers(spark, path)[kept:]:
        _forget(spark, path, number)


def _commit(spark: SparkSession, path: str, number: int, name: str) -> None:
    target, system = _path(spark, f"{path}/{_MANIFESTS}/{number:09d}")
    if system.exists(target):
        raise FileExistsError(f"version {number} of {path} was written by another run")
    stream = system.create(target, False)
    try:
        stream.write(bytearray(f"{name}\n".encode()))
    finally:
        stream.close()
    log.info("version %d of %s is current", number, path)


def _forget(spark: SparkSession, path: str, number: int) -> None:
    """Delete a version, its manifest first."""
    name = _named(spark, path, number)
    for old in (f"{path}/{_MANIFESTS}/{number:09d}", f"{path}/{name}" if name else None):
        if old:
            target, system = _path(spark, old)
            system.delete(target, True)


@contextmanager
def swapped(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to fill beside ``path``; it takes its place when the block ends well.

    The old folder is moved aside, the new one moved in, then the old one
    deleted; a write that fails or reads ``path`` itself finds it as it was.
    """
    mark, path = uuid.uuid4().hex, path.rstrip("/")
    fresh, system = _path(spark, f"{path}.new-{mark}")
    target, _ = _path(spark, path)
    aside, _ = _path(spark, f"{path}.old-{mark}")
    try:
        yield f"{path}.new-{mark}"
        there = system.exists(target)
        if there and not system.rename(target, aside):
            raise OSError(f"{path} can't be moved aside")
        if not system.rename(fresh, target):
            if there:
                system.rename(aside, target)
            raise OSError(f"{path} can't be replaced")
    except BaseException:
        system.delete(fresh, True)
        raise
    system.delete(aside, True)
