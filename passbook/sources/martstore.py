"""Marts in versions: written aside, tested, then published all at once.

Below the base folder::

    <mart>/gen=<id>/bucket=<k>/…    files of one build; ``bucket`` is the hash of the mart's key
    head/                           the current version (see ``pointer``)

The head names, for every mart and bucket, the generation that holds it. A build writes new generations and
moves the head only after its tests have passed: until then, and for ever if they fail, readers see the
marts of the build before. A build that recomputes some buckets names the old generations for the others. A mart
and its neighbours in the head are of one build, so a reader that keeps a ``version`` sees them consistently.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.sources import pointer
from passbook.sources.landing import table_path

BUCKET = "bucket"
BUCKETS = 64


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    """Bucket of a key; rows without key have one too."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def version(spark: SparkSession, base: str) -> dict:
    """The published version: ``marts`` by name, and what the build noted about itself."""
    return {"marts": {}, "notes": {}} | pointer.latest(spark, f"{base.rstrip('/')}/head")[1]


class Build:
    """A build in progress: what it has written, and what the version it started from holds.

    Until ``publish`` nothing of it is visible. It fails if another build has published meanwhile.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.id = uuid.uuid4().hex
        self.started_from, document = pointer.latest(spark, f"{self.base}/head")
        self.before = {"marts": {}, "notes": {}} | document
        self.marts: dict[str, dict] = {}
        self.notes: dict = {}

    def write(
        self,
        name: str,
        rows: DataFrame,
        key: str | None = None,
        buckets: int = BUCKETS,
        replaced: list[int] | None = None,
    ) -> DataFrame:
        """Write a mart, whole or only the buckets in ``replaced``, and return it as it will be published.

        ``key`` says which column decides the bucket; without it the mart is one bucket.
        """
        path = f"{table_path(self.base, name)}/gen={self.id}"
        rows = rows.withColumn(BUCKET, bucket_of(F.col(key), buckets) if key else F.lit(0))
        rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        layout = T.StructType([f for f in rows.schema.fields if f.name != BUCKET])
        numbers = list(range(buckets if key else 1)) if replaced is None else sorted(replaced)
        kept = {} if replaced is None else dict(self.before["marts"].get(name, {"generations": {}})["generations"])
        entry = {
            "schema": layout.json(),
            "key": key,
            "buckets": buckets if key else 1,
            "generations": kept | {str(k): self.id for k in numbers},
        }
        self.marts[name] = entry
        return self.read(name)

    def read(self, name: str, only: list[int] | None = None) -> DataFrame:
        """A mart as this build has it: its own buckets, else those of the version before."""
        found = self.marts.get(name) or self.before["marts"][name]
        return _read(self.spark, self.base, name, found, only)

    def publish(self, **notes) -> dict:
        """Move the head to this build: all its marts become visible at once."""
        document = {"marts": self.before["marts"] | self.marts, "notes": self.before["notes"] | self.notes | notes, "build": self.id}
        pointer.publish(self.spark, f"{self.base}/head", self.started_from, document)
        return document


def _read(spark: SparkSession, base: str, name: str, entry: dict, only: list[int] | None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    wanted: dict[str, list[int]] = {}
    for bucket, generation in entry["generations"].items():
        if only is None or int(bucket) in only:
            wanted.setdefault(generation, []).append(int(bucket))
    layout = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    rows = spark.createDataFrame([], layout)
    for number, (generation, buckets) in enumerate(sorted(wanted.items())):
        part = spark.read.schema(layout).parquet(f"{table_path(base, name)}/gen={generation}")
        if only is not None or len(wanted) > 1:
            part = part.filter(F.col(BUCKET).isin(buckets))  # prunes folders
        rows = part if number == 0 else rows.unionByName(part)
    return rows


def read_mart(spark: SparkSession, base: str, name: str, of: dict | None = None) -> DataFrame:
    """A published mart. Keep ``of = version(spark, base)`` to read several of the same build."""
    entry = (of or version(spark, base))["marts"][name]
    return _read(spark, base.rstrip("/"), name, entry, None).drop(BUCKET)


def as_mart(build: Build, keys: dict[str, str], buckets: int = BUCKETS) -> Callable[[str, DataFrame], DataFrame]:
    """How ``plans.build.build_models`` keeps its tables in a build."""

    def write(name: str, rows: DataFrame) -> DataFrame:
        return build.write(name, rows, keys.get(name), buckets).drop(BUCKET)

    return write


def drop_old_builds(spark: SparkSession, base: str, names: list[str]) -> int:
    """Delete generations that the current version does not name; returns how many.

    Run it when no reader of an earlier version and no build is at work. One folder per mart and build.
    """
    current = version(spark, base)["marts"]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    for name in names:
        path = hadoop.Path(table_path(base, name))
        files = path.getFileSystem(conf)
        if not files.exists(path):
            continue
        live = set(current.get(name, {"generations": {}})["generations"].values())
        for status in files.listStatus(path):
            if status.getPath().getName().removeprefix("gen=") not in live:
                gone += files.delete(status.getPath(), True)
    return gone
