"""A small document that jobs replace as a whole: what readers of a folder may see.

Every version is a file of its own, numbered upwards; the highest number counts. A version is written under
another name and then renamed, and a rename onto an existing version fails, so of two writers one wins and
the other starts again from what the winner wrote. A reader sees one version or the next, never half of one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

KEPT_VERSIONS = 100
ATTEMPTS = 50


class ConflictError(RuntimeError):
    """Another writer was faster."""


def _hadoop(spark: SparkSession, folder: str):
    java = spark.sparkContext._jvm
    path = java.org.apache.hadoop.fs.Path(folder)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return java, path, path.getFileSystem(conf), conf


def _versions(fs, path) -> list[int]:
    if not fs.exists(path):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(path))
    return sorted(int(name[:-5]) for name in names if name.endswith(".json"))


def latest(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """The highest version and its document; (0, {}) if there is none."""
    java, path, fs, _ = _hadoop(spark, folder)
    versions = _versions(fs, path)
    if not versions:
        return 0, {}
    stream = fs.open(java.org.apache.hadoop.fs.Path(path, f"{versions[-1]:020d}.json"))
    try:
        text = java.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return versions[-1], json.loads(text)


def publish(spark: SparkSession, folder: str, after: int, document: dict) -> int:
    """Write the version that follows ``after``; ``ConflictError`` if it exists already."""
    java, path, fs, conf = _hadoop(spark, folder)
    fs.mkdirs(path)
    temporary = java.org.apache.hadoop.fs.Path(path, f"_{uuid.uuid4().hex}")
    target = java.org.apache.hadoop.fs.Path(path, f"{after + 1:020d}.json")
    out = fs.create(temporary, False)
    out.write(bytearray(json.dumps(document, sort_keys=True), "utf-8"))
    out.close()
    context = java.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf)
    kind = getattr(java.org.apache.hadoop.fs, "Options$Rename")
    none = spark.sparkContext._gateway.new_array(kind, 1)
    none[0] = kind.NONE
    try:
        context.rename(temporary, target, none)
    except Py4JJavaError as error:
        fs.delete(temporary, False)
        if not fs.exists(target):
            raise
        raise ConflictError(f"version {after + 1} of {folder} exists") from error
    for old in _versions(fs, path)[:-KEPT_VERSIONS]:
        fs.delete(java.org.apache.hadoop.fs.Path(path, f"{old:020d}.json"), False)
    return after + 1


def update(spark: SparkSession, folder: str, change: Callable[[dict], dict | None]) -> dict:
    """Replace the document by ``change`` of it, again from the newest one if another writer was faster.

    ``change`` returns None to leave it as it is.
    """
    for _ in range(ATTEMPTS):
        version, document = latest(spark, folder)
        wanted = change(json.loads(json.dumps(document)))
        if wanted is None:
            return document
        try:
            publish(spark, folder, version, wanted)
        except ConflictError:
            continue
        return wanted
    raise ConflictError(f"{folder} changed {ATTEMPTS} times in a row")
