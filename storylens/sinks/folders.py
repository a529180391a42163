"""Output folders in versions: what stands under a name changes as a whole, or not at all.

A folder that is published under a name holds its versions, each a folder of its own
that never changes, and manifests. A manifest is one small file that names the
folders of a version; it is written last, and none is ever replaced. Readers take the
newest manifest that is whole. So an error at any step leaves what was readable before,
nothing is renamed (object stores copy on a rename), and who reads a version while the next
one comes goes on with the files it has listed.

Names of versions begin with a dot: a reader that does not resolve the name finds nothing there, rather
than two versions at once. They look like partitions, so that those above and below them are found.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

_log = logging.getLogger(__name__)

MANIFESTS = "_manifests"
VERSION = ".v="
#: Versions before the newest that are kept for those who read them.
KEPT = 1


@dataclass
class Version:
    """What a manifest says: the folders of the data below the published one, and notes of the writer."""

    number: int
    folders: list[str]
    notes: dict = field(default_factory=dict)


def file_system(spark: SparkSession, path: str):
    """The file system of a path."""
    return _hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(_hadoop_path(spark, path))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    fs = file_system(spark, path)
    folder = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def _number(name: str) -> int:
    """The number in the name of a version or manifest, -1 in other names."""
    digits = name.removeprefix(VERSION).split("-")[0]
    return int(digits) if digits.isdigit() else -1


def _manifest(spark: SparkSession, path: str, name: str) -> Version | None:
    """A manifest, or None if its writer was stopped before its end."""
    fs = file_system(spark, path)
    stream = fs.open(_hadoop_path(spark, f"{path}/{MANIFESTS}/{name}"))
    try:
        text = bytes(stream.readAllBytes())
    finally:
        stream.close()
    try:
        said = json.loads(text)
        return Version(_number(name), said["folders"], said["notes"])
    except (ValueError, KeyError, TypeError):
        return None


def _versions(spark: SparkSession, path: str, most: int) -> list[Version]:
    """The newest whole versions, newest first."""
    out: list[Version] = []
    for name in sorted((n for n in names(spark, f"{path}/{MANIFESTS}") if _number(n) >= 0), reverse=True):
        found = _manifest(spark, path, name)
        out += [found] if found else []
        if len(out) == most:
            break
    return out


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest version of a published folder, None if there is none."""
    return next(iter(_versions(spark, path.rstrip("/"), 1)), None)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Paths to read for a published folder; a folder without manifests is read as it is."""
    path = path.rstrip("/")
    found = current(spark, path)
    return [path] if found is None else [f"{path}/{f}" for f in found.folders]


def publish(spark: SparkSession, path: str, write: Callable[[str], list[str] | None], kept: list[str] | None = None,
            notes: dict | None = None) -> list[str]:
    """Let ``write`` fill a new version and make it the current one; returns the paths of its folders.

    ``write`` may return the names of the folders below the new one that hold the data (by
    default it is the new one itself); ``kept`` are folders of earlier versions that belong to this one, too.
    If anything fails before the manifest stands, the earlier version stays current. Afterwards only
    old versions are removed, and a failure there is logged.
    """
    path = path.rstrip("/")
    known = [_number(n) for n in names(spark, f"{path}/{MANIFESTS}") + names(spark, path)]
    number = max([0, *known]) + 1
    version = f"{VERSION}{number:08d}-{uuid.uuid4().hex[:12]}"
    try:
        below = write(f"{path}/{version}")
    except BaseException:
        _removed(spark, f"{path}/{version}")
        raise
    held = [version] if below is None else [f"{version}/{b}" for b in below]
    said = json.dumps({"folders": held + (kept or []), "notes": notes or {}}).encode()
    # From here on nothing of the version is removed if a step fails: the manifest may stand.
    fs = file_system(spark, path)
    stream = fs.create(_hadoop_path(spark, f"{path}/{MANIFESTS}/{number:08d}-{uuid.uuid4().hex[:12]}.json"), False)
    try:
        stream.write(bytearray(said))
    finally:
        stream.close()
    try:
        _tidy(spark, path)
    except Exception as e:  # noqa: BLE001 - whatever the storage's client raises
        _log.warning("old versions in %s could not be removed: %s", path, e)
    return [f"{path}/{f}" for f in held + (kept or [])]


def _tidy(spark: SparkSession, path: str) -> None:
    """Remove what neither the newest versions name nor a writer at work may still name."""
    recent = _versions(spark, path, KEPT + 1)
    oldest = recent[-1].number
    used = {f.split("/")[0] for v in recent for f in v.folders}
    for name in names(spark, path):
        if name.startswith(VERSION) and 0 <= _number(name) < oldest and name not in used:
            _removed(spark, f"{path}/{name}")
    for name in names(spark, f"{path}/{MANIFESTS}"):
        if 0 <= _number(name) < oldest:
            _removed(spark, f"{path}/{MANIFESTS}/{name}")


def _removed(spark: SparkSession, path: str) -> None:
    try:
        file_system(spark, path).delete(_hadoop_path(spark, path), True)
    except Exception as e:  # noqa: BLE001 - whatever the storage's client raises
        _log.warning("%s could not be removed: %s", path, e)
