"""Committing a dataset in two phases: a staged version folder, then a pointer that names it.

Below one root lie ``stages/<id>`` folders, written at leisure, and ``pointers/<number>`` files. A version counts from
the moment its pointer is there: it is created only if no file has its number, so of two builders one gets it and the
other takes the next. A pointer carries a digest of itself; one cut off in writing is passed over. The newest whole
pointer names the current version, so a reader sees the older complete version or the newer one, never a part.

A build that dies in any step leaves a stage without a pointer; the root stays usable and the next try simply succeeds.
:func:`recover` removes such stages once they are older than a builder may take, and versions no longer current.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import SparkSession

from markfield.plans.build import build
from markfield.plans.validate import validate

#: Age from which a stage without a pointer is taken for broken, in seconds.
ABANDONED = 7 * 86_400
TRIES = 100


def _system(spark: SparkSession, path: str) -> tuple[Any, Callable[[str], Any]]:
    paths = spark._jvm.org.apache.hadoop.fs.Path
    return paths(path).getFileSystem(spark._jsc.hadoopConfiguration()), paths


def _children(spark: SparkSession, folder: str) -> list[tuple[str, float]]:
    """Names and times of change of what lies in a folder; as many as there were commits and broken stages."""
    system, path = _system(spark, folder)
    if not system.exists(path(folder)):
        return []
    return [(status.getPath().getName(), status.getModificationTime() / 1000) for status in system.listStatus(path(folder))]


def _pointers(spark: SparkSession, root: str) -> list[str]:
    """Names of pointer files, the newest first."""
    return sorted((name for name, _ in _children(spark, f"{root}/pointers") if name.isdigit()), reverse=True)


def _named(spark: SparkSession, root: str, pointer: str) -> str | None:
    """The stage a pointer names, or nothing if the pointer or the stage is not whole."""
    system, path = _system(spark, root)
    stream = system.open(path(f"{root}/pointers/{pointer}"))
    try:
        text = bytes(stream.readAllBytes()).decode("utf-8", "replace")
    finally:
        stream.close()
    digest, _, body = text.partition("\n")
    if hashlib.sha256(body.encode()).hexdigest() != digest:
        return None
    stage = json.loads(body)["stage"]
    return stage if system.exists(path(f"{root}/stages/{stage}")) else None


def current(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest committed version, or nothing before the first."""
    for pointer in _pointers(spark, root):
        if stage := _named(spark, root, pointer):
            return f"{root}/stages/{stage}"
    return None


def _point(spark: SparkSession, root: str, stage: str) -> None:
    """Create the next free pointer; the commit."""
    system, path = _system(spark, root)
    body = json.dumps({"stage": stage, "committed_at": time.time()})
    content = f"{hashlib.sha256(body.encode()).hexdigest()}\n{body}".encode()
    for _ in range(TRIES):
        number = int(next(iter(_pointers(spark, root)), "0")) + 1
        target = path(f"{root}/pointers/{number:012d}")
        try:
            stream = system.create(target, False)
        except Exception:
            if system.exists(target):
                continue  # another builder took this number
            raise
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()
        return
    raise RuntimeError(f"no free pointer below {root} after {TRIES} tries")


def commit_version(spark: SparkSession, root: str, write: Callable[[str], Any]) -> Any:
    """Let ``write`` fill a fresh stage, then make it the current version; returns what ``write`` returns."""
    stage = uuid.uuid4().hex
    folder = f"{root}/stages/{stage}"
    try:
        result = write(folder)
        if not _children(spark, folder):
            raise ValueError("nothing was written")
    except BaseException:
        system, path = _system(spark, folder)
        system.delete(path(folder), True)
        raise
    _point(spark, root, stage)
    return result


def recover(spark: SparkSession, root: str, *, abandoned: float = ABANDONED, keep: int = 2) -> list[str]:
    """Remove broken stages and all but the ``keep`` newest versions; returns the stages removed."""
    system, path = _system(spark, root)
    named = [stage for pointer in _pointers(spark, root) if (stage := _named(spark, root, pointer))]
    old = time.time() - abandoned
    gone = [stage for stage, changed in _children(spark, f"{root}/stages")
            if stage in named[keep:] or stage not in named and changed <= old]
    for stage in gone:
        system.delete(path(f"{root}/stages/{stage}"), True)
    return gone


def build_version(spark: SparkSession, source: str, root: str, split_map: Mapping[str, str] | None = None,
                  overrides: Mapping[str, str] | None = None, **options: Any) -> dict:
    """Build, validate and commit a dataset as the root's next version; returns its manifest."""
    def write(folder: str) -> dict:
        manifest = build(spark, source, folder, split_map, overrides, **options)
        validate(spark, folder)
        return manifest

    return commit_version(spark, root, write)
