"""Overwriting that a crash cannot spoil: staged folders, and a pointer per version.

A versioned target is a folder::

    data/<name>/          one folder per attempt to write; nothing in it ever changes
    pointers/00000001     which of them is version 1, and what it holds

A new version is written to a folder of its own and counts from the moment its pointer is
there, which appears at once or not at all. Whatever fails before leaves the version of
before as it was; whoever reads keeps the folder found at the start.
"""

import json
import time
import uuid
from collections.abc import Callable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tastemap.sources.tables import check_target, read_table

DATA, POINTERS = "data", "pointers"
# An unpublished folder younger than this may belong to a running job, seconds.
GRACE = 24 * 3600


class Version(NamedTuple):
    number: int
    path: str
    fmt: str
    files: int
    size: int
    written: float


class Conflict(RuntimeError):
    """Someone else has published since the version that a job started from."""


def _store(spark: SparkSession, path: str):
    """Hadoop's path and file system of a name."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    place, store = _store(spark, path)
    if not store.exists(place):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(place))


def is_versioned(spark: SparkSession, target: str) -> bool:
    place, store = _store(spark, f"{target.rstrip('/')}/{POINTERS}")
    return store.exists(place)


def versions(spark: SparkSession, target: str) -> list[Version]:
    """Published versions, oldest first."""
    root = target.rstrip("/")
    found = []
    for name in _names(spark, f"{root}/{POINTERS}"):
        if name.isdigit():
            place, store = _store(spark, f"{root}/{POINTERS}/{name}")
            if not store.exists(place):  # removed since it was listed
                continue
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(store.open(place), "UTF-8")
            held = json.loads(text)
            found.append(Version(int(name), f"{root}/{DATA}/{held['folder']}", held["format"],
                                 held["files"], held["size"], held["written"]))
    return found


def current(spark: SparkSession, target: str, number: int | None = None) -> Version:
    """The newest version, or the one asked for."""
    found = [v for v in versions(spark, target) if number in (None, v.number)]
    if not found:
        raise FileNotFoundError(f"{target} has no version" + (f" {number}" if number else ""))
    return found[-1]


def resolve(spark: SparkSession, target: str) -> str:
    """The folder to read: the newest version's, or ``target`` itself if it has no versions."""
    return current(spark, target).path if is_versioned(spark, target) else target


def read_version(spark: SparkSession, target: str, number: int | None = None,
                 schema=None, **options) -> DataFrame:
    """The newest version or the one asked for; later ones do not change what this reads."""
    found = current(spark, target, number)
    return read_table(spark, found.path, found.fmt, schema, **options)


def publish(df: DataFrame, target: str, fmt: str = "parquet", *, sources=(), keep: int | None = None,
            after: int | None = None, **options) -> Version:
    """Write ``df`` as the next version of ``target``, which may also be what ``df`` reads.

    If the job fails, or its executors are lost for good, the version of before stays the
    newest. Of jobs that publish at the same time all succeed, one after the other, unless
    one says ``after`` which version it must come: then it raises :class:`Conflict` if
    another came in between. ``keep`` removes all but so many versions afterwards.
    """
    spark = df.sparkSession
    return _publish(spark, target, fmt, lambda path: df.write.format(fmt).mode("error")
                    .options(**options).save(path), sources, keep, after)


def publish_model(model, target: str, *, sources=(), keep: int | None = None,
                  after: int | None = None) -> Version:
    """:func:`publish` of a fitted model; load it from :func:`resolve`."""
    return _publish(SparkSession.active(), target, "model", model.save, sources, keep, after)


def _publish(spark: SparkSession, target: str, fmt: str, write: Callable[[str], None], sources,
             keep, after) -> Version:
    root = target.rstrip("/")
    for source in sources:
        check_target(spark, f"{root}/{POINTERS}", [source])
    folder = uuid.uuid4().hex
    staged = f"{root}/{DATA}/{folder}"
    place, store = _store(spark, staged)
    try:
        write(staged)
        summary = store.getContentSummary(place)
        held = {"folder": folder, "format": fmt, "files": summary.getFileCount(),
                "size": summary.getLength(), "written": time.time()}
        while True:
            newest = max((v.number for v in versions(spark, root)), default=0)
            if after is not None and newest != after:
                raise Conflict(f"{target} is at version {newest}, not {after}")
            if _claim(spark, root, newest + 1, json.dumps(held)):
                break
    except BaseException:
        store.delete(place, True)
        raise
    if keep is not None:
        vacuum(spark, root, keep)
    return Version(newest + 1, staged, fmt, held["files"], held["size"], held["written"])


def _claim(spark: SparkSession, root: str, number: int, text: str) -> bool:
    """Let a pointer appear whole, if there is none of that number yet."""
    name = f"{root}/{POINTERS}/{number:08d}"
    place, store = _store(spark, name)
    draft, _ = _store(spark, f"{root}/{POINTERS}/.{number:08d}-{uuid.uuid4().hex}")
    out = store.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm = spark._jvm
    try:
        uri = store.makeQualified(place).toUri()
        if uri.getScheme() == "file":
            # A rename would replace a pointer that is there; a link does not.
            files, none = jvm.java.nio.file.Files, spark._sc._gateway.new_array(jvm.String, 0)
            old = jvm.java.nio.file.Paths.get(store.makeQualified(draft).toUri().getPath(), none)
            files.createLink(jvm.java.nio.file.Paths.get(uri.getPath(), none), old)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                uri, spark._jsc.hadoopConfiguration())
            kinds = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            kinds[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
            context.rename(draft, place, kinds)
        return True
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        store.delete(draft, False)


def vacuum(spark: SparkSession, target: str, keep: int = 2, grace: float = GRACE) -> list[str]:
    """Remove all but the newest ``keep`` versions, and what failed jobs left behind.

    A folder without a pointer goes once it is older than ``grace`` seconds. Pointers go
    before their data, so that no pointer ever leads nowhere. Gives the removed folders.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    root = target.rstrip("/")
    found = versions(spark, root)
    for old in found[:-keep]:
        place, store = _store(spark, f"{root}/{POINTERS}/{old.number:08d}")
        store.delete(place, False)
    kept = {v.path.rsplit("/", 1)[1] for v in found[-keep:]}
    superseded = {v.path.rsplit("/", 1)[1] for v in found[:-keep]}
    removed = []
    for name in _names(spark, f"{root}/{DATA}"):
        place, store = _store(spark, f"{root}/{DATA}/{name}")
        if name in kept:
            continue
        if name in superseded or _touched(store, place) < time.time() - grace:
            store.delete(place, True)
            removed.append(f"{root}/{DATA}/{name}")
    return removed


def _touched(store, place) -> float:
    """When a folder or something right inside was last changed, in seconds."""
    times = [store.getFileStatus(place).getModificationTime()]
    times += [s.getModificationTime() for s in store.listStatus(place)]
    return max(times) / 1000
