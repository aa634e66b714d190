"""Landing zone: Parquet files that a manifest publishes, one zone per table.

Below a table's folder::

    open/batch=<id>/          one folder per write, partition columns inside the files
    closed/gen=<id>/year=…/month=…/day=…/hour=…/    hours closed into few files
    manifest/head/            the current version (see ``pointer``): open batches, listing, committed batches
    manifest/listing-<id>/    one row per closed hour and per folder that waits for deletion

A write puts its files into a folder that no reader looks at and then publishes the folder in the manifest.
A job that dies in between leaves files nobody sees; a repeated batch finds its number published and adds
nothing. ``close_hours`` moves open batches, together with what their hours held, into one folder per hour, so the
number of folders follows the hours and not the batches. Folders that a newer version no longer names are
deleted by ``vacuum``, after readers of the older version have had time to finish.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.contracts import PARTITION_COLUMNS, landing_schema
from passbook.sources import pointer
from passbook.workspace import stored

BATCH = "batch"
GENERATION = "gen"
#: One row per closed hour; ``dropped_ms`` is set once a newer version has replaced the folder. Batch folders that were
#: closed wait for deletion here too, without an hour.
LISTING = "folder string, year string, month string, day string, hour string, rows bigint, dropped_ms bigint"


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def _head(base: str, table: str) -> str:
    return f"{table_path(base, table)}/manifest/head"


def head(spark: SparkSession, base: str, table: str) -> dict:
    """The published version: ``open`` (batch ids), ``listing`` (path or None), ``streams`` (last committed number)."""
    found = pointer.latest(spark, _head(base, table))[1]
    return {"open": [], "listing": None, "streams": {}} | found


def listing(spark: SparkSession, base: str, table: str, version: dict | None = None) -> DataFrame:
    """Closed hours and dropped folders of a version, as a table."""
    version = version or head(spark, base, table)
    if version["listing"] is None:
        return spark.createDataFrame([], LISTING)
    return spark.read.schema(LISTING).parquet(f"{table_path(base, table)}/{version['listing']}")


def live_hours(spark: SparkSession, base: str, table: str, version: dict | None = None) -> DataFrame:
    return listing(spark, base, table, version).filter("dropped_ms is null")


# --- reading ---------------------------------------------------------------------------------


def _from(parts: list[str], beyond) -> Column:
    """Year, month and day at a day or beyond it, as comparisons of the columns themselves."""
    year, month, day = (F.col(c) for c in PARTITION_COLUMNS[:3])
    y, m, d = parts
    on = beyond(day, d) | (day == d)
    return beyond(year, y) | ((year == y) & (beyond(month, m) | ((month == m) & on)))


def _between(rows: DataFrame, since: str | None, until: str | None) -> DataFrame:
    if since is not None:
        rows = rows.filter(_from(since.split("-"), lambda part, bound: part > bound))
    if until is not None:
        rows = rows.filter(_from(until.split("-"), lambda part, bound: part < bound))
    return rows


def _folders(spark: SparkSession, base: str, table: str, batches: list[str], hours: list[str]) -> DataFrame:
    """Rows of some open batches and closed hours."""
    path, contract = table_path(base, table), landing_schema(table)
    rows = spark.createDataFrame([], contract)
    if hours:
        layout = T.StructType([*contract.fields, T.StructField(GENERATION, T.StringType())])
        reader = spark.read.schema(layout).option("basePath", f"{path}/closed")
        rows = reader.parquet(*(f"{path}/{folder}" for folder in hours)).drop(GENERATION)
    if batches:
        opened = spark.read.schema(contract).parquet(*(f"{path}/open/{BATCH}={b}" for b in batches))
        rows = rows.unionByName(opened) if hours else opened
    return rows


def scan(
    spark: SparkSession,
    base: str,
    table: str,
    since: str | None = None,
    until: str | None = None,
    version: dict | None = None,
) -> DataFrame:
    """Rows of a landing table; with ``since`` and ``until`` (``yyyy-MM-dd``, inclusive) only those days' folders.

    Which folders are read is settled now, from the manifest: writes published later do not change the frame.
    ``version`` (see ``head``) reads an earlier version, as long as its folders have not been deleted.
    The names of the hour folders that are read pass through the driver, one for each hour.
    """
    version = version or head(spark, base, table)
    hours = _between(live_hours(spark, base, table, version), since, until)
    folders = [r["folder"] for r in hours.select("folder").collect()]
    return _between(_folders(spark, base, table, version["open"], folders), since, until)


def scan_since(spark: SparkSession, base: str, table: str, before: dict, now: dict | None = None) -> DataFrame:
    """Rows of the folders that the version ``before`` did not name yet, as of the version ``now``.

    All rows written since then are among them. Rows that were there before come again if their hour has been
    closed anew meanwhile, so readers must not mind repeated rows; the models drop them anyway.
    """
    now = now or head(spark, base, table)
    known = live_hours(spark, base, table, before).select("folder")
    fresh = live_hours(spark, base, table, now).join(known, "folder", "left_anti")
    batches = [b for b in now["open"] if b not in set(before["open"])]
    return _folders(spark, base, table, batches, [r["folder"] for r in fresh.select("folder").collect()])


# --- writing ---------------------------------------------------------------------------------


def _numbered(batch: str) -> tuple[str, int] | None:
    """Stream and number of a batch id such as ``s1-17``."""
    found = re.fullmatch(r"(.+)-(\d+)", batch)
    return (found[1], int(found[2])) if found else None


def is_committed(version: dict, batch: str) -> bool:
    """Batches of a stream are numbered upwards and written one after another: lower numbers are in."""
    numbered = _numbered(batch)
    if numbered is None:
        return batch in version["open"]
    return numbered[1] <= version["streams"].get(numbered[0], -1)


def _in_hours(rows: DataFrame) -> DataFrame:
    """An hour in few files; one that is too large in several."""
    return rows.hint("rebalance", *PARTITION_COLUMNS)


def write_rows(rows: DataFrame, base: str, table: str, batch: str | None = None) -> bool:
    """Add rows as one batch; False if that batch is in already.

    ``batch`` is ``<stream>-<number>``, numbers rising: a batch that is repeated after a crash is written again
    if it was not published, and left alone if it was. Without ``batch`` the rows are added under a new name.
    """
    spark = rows.sparkSession
    batch = batch or uuid.uuid4().hex
    if is_committed(head(spark, base, table), batch):
        return False
    path = f"{table_path(base, table)}/open/{BATCH}={batch}"
    rows.select(*landing_schema(table).names).sortWithinPartitions(*PARTITION_COLUMNS).write.mode("overwrite").parquet(path)
    _publish_batch(spark, base, table, batch)
    return True


def _publish_batch(spark: SparkSession, base: str, table: str, batch: str) -> None:
    def change(document: dict) -> dict | None:
        version = {"open": [], "listing": None, "streams": {}} | document
        if is_committed(version, batch):
            return None
        numbered = _numbered(batch)
        if numbered:
            version["streams"][numbered[0]] = numbered[1]
        return version | {"open": [*version["open"], batch]}

    pointer.update(spark, _head(base, table), change)


def _write_listing(rows: DataFrame, base: str, table: str) -> str:
    name = f"manifest/listing-{uuid.uuid4().hex}"
    rows.write.parquet(f"{table_path(base, table)}/{name}")
    return name


def _publish_listing(spark: SparkSession, base: str, table: str, was: dict, name: str, closed: list[str]) -> None:
    """Publish a listing made from the version ``was``; batches published meanwhile stay open."""

    def change(document: dict) -> dict:
        version = {"open": [], "listing": None, "streams": {}} | document
        if version["listing"] != was["listing"]:
            raise pointer.ConflictError(f"{table}: another job has changed the hours meanwhile; run this one again")
        return version | {"listing": name, "open": [b for b in version["open"] if b not in closed]}

    pointer.update(spark, _head(base, table), change)


def close_hours(spark: SparkSession, base: str, table: str) -> int:
    """Move all open batches into hour folders; returns the number of hours written.

    An hour that had a folder already, and gets late rows, is written anew with them: every hour has one folder.
    The rows go to a generation of their own; nothing is renamed or replaced in place.
    """
    was = head(spark, base, table)
    if not was["open"]:
        return 0
    now = int(time.time() * 1000)
    opened = _folders(spark, base, table, was["open"], [])
    touched = opened.select(*PARTITION_COLUMNS).distinct()
    earlier = live_hours(spark, base, table, was).join(touched, PARTITION_COLUMNS, "left_semi")
    replaced = [r["folder"] for r in earlier.select("folder").collect()]
    rows = _folders(spark, base, table, was["open"], replaced)
    generation = uuid.uuid4().hex
    path = table_path(base, table)
    _in_hours(rows).write.partitionBy(*PARTITION_COLUMNS).parquet(f"{path}/closed/{GENERATION}={generation}")

    written = (
        _closed(spark, base, table, generation)
        .groupBy(*PARTITION_COLUMNS)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(_folder_name(generation).alias("folder"), *PARTITION_COLUMNS, "rows", F.lit(None).cast("bigint").alias("dropped_ms"))
    )
    names = earlier.select(F.col("folder").alias("_replaced"))
    kept = listing(spark, base, table, was).join(names, F.col("folder") == F.col("_replaced"), "left")
    dropped = F.when(F.col("_replaced").isNotNull(), F.lit(now)).otherwise(F.col("dropped_ms"))
    kept = kept.withColumn("dropped_ms", dropped).drop("_replaced")
    none = F.lit(None).cast("string")
    batches = spark.createDataFrame([(f"open/{BATCH}={b}",) for b in was["open"]], "folder string").select(
        "folder", *(none.alias(c) for c in PARTITION_COLUMNS), F.lit(0).cast("bigint").alias("rows"), F.lit(now).alias("dropped_ms")
    )
    name = _write_listing(kept.unionByName(written).unionByName(batches).coalesce(8), base, table)
    _publish_listing(spark, base, table, was, name, was["open"])
    return spark.read.schema(LISTING).parquet(f"{path}/{name}").filter(F.col("folder").startswith(f"closed/{GENERATION}={generation}/")).count()


def _closed(spark: SparkSession, base: str, table: str, generation: str) -> DataFrame:
    """All rows of one generation, partition columns from its folders."""
    return spark.read.schema(landing_schema(table)).parquet(f"{table_path(base, table)}/closed/{GENERATION}={generation}")


def _folder_name(generation: str) -> Column:
    parts = [F.lit(f"closed/{GENERATION}={generation}")]
    for name in PARTITION_COLUMNS:
        parts += [F.lit(f"/{name}="), F.col(name)]
    return F.concat(*parts)


def drop_hours(spark: SparkSession, base: str, table: str, which: Column) -> DataFrame:
    """Take the closed hours for which ``which`` (over year, month, day, hour) holds out of the manifest.

    Returns them. Readers no longer see them from here on; ``vacuum`` deletes their folders.
    """
    was = head(spark, base, table)
    dropped = live_hours(spark, base, table, was).filter(which)
    if dropped.isEmpty():
        return dropped
    now = F.lit(int(time.time() * 1000))
    out = which & F.col("dropped_ms").isNull()
    changed = listing(spark, base, table, was).withColumn("dropped_ms", F.when(out, now).otherwise(F.col("dropped_ms")))
    _publish_listing(spark, base, table, was, _write_listing(changed.coalesce(8), base, table), [])
    return dropped


def _deleted(root: str):
    """Deletes folders below ``root`` from within tasks. A folder that is gone already is no error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        files, path = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                folder = f"{path.rstrip('/')}/{name}"
                if files.get_file_info(folder).type != pafs.FileType.NotFound:
                    files.delete_dir(folder)
            yield batch.select([0])

    return run


def vacuum(spark: SparkSession, base: str, table: str, grace_ms: int = 24 * 60 * 60 * 1000) -> int:
    """Delete the folders that were dropped ``grace_ms`` ago or longer; returns how many.

    Which ones is known from the listing, so nothing is listed; tasks delete them. For stores that pyarrow does not
    reach, have the store expire the folders of ``listing(...)`` with ``dropped_ms``.
    """
    was = head(spark, base, table)
    known = listing(spark, base, table, was)
    due = F.col("dropped_ms").isNotNull() & (F.col("dropped_ms") <= int(time.time() * 1000) - grace_ms)
    root = _store_uri(table_path(base, table))
    gone = known.filter(due).select("folder").repartition(spark.sparkContext.defaultParallelism)
    n = gone.mapInArrow(_deleted(root), "folder string").count()
    if n:
        left = known.filter(~due)
        _publish_listing(spark, base, table, was, _write_listing(left.coalesce(8), base, table), [])
    return n


# --- foreign files, whose schema was inferred file by file -----------------------------------


def _as_contract(rows: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns by name; what is missing or does not fit its type becomes null."""
    found = {f.name: f.dataType for f in rows.schema.fields}

    def column(field: T.StructField) -> Column:
        if field.name not in found:
            return F.lit(None).cast(field.dataType)
        if found[field.name] == field.dataType:
            return F.col(field.name)
        # as text: keeps every digit whatever scale a file chose, and a column without values fits any type
        return F.col(field.name).cast("string").try_cast(field.dataType)

    return rows.select(*(column(f).alias(f.name) for f in contract.fields))


def _store_uri(path: str) -> str:
    """A path as pyarrow names it; Spark writes local files as ``file:/a/b``."""
    if re.match(r"^[a-z0-9+]+://", path):
        return path
    return "file:///" + path.removeprefix("file:").lstrip("/")


def _footer_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folder, path and column types of each file, from its footer."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    for batch in batches:
        paths = batch.column(0).to_pylist()
        schemas = []
        for path in paths:
            files, name = pafs.FileSystem.from_uri(_store_uri(path))
            columns = pq.read_schema(name, filesystem=files).remove_metadata()
            # a column without values has no type of its own; it is stored as numbers, all null
            typed = [pa.field(c.name, pa.int32()) if pa.types.is_null(c.type) else pa.field(c.name, c.type) for c in columns]
            schemas.append(from_arrow_schema(pa.schema(typed), prefer_timestamp_ntz=True).json())
        folders = [path.rpartition("/")[0] for path in paths]
        yield pa.RecordBatch.from_arrays([pa.array(folders), pa.array(paths), pa.array(schemas)], ["folder", "path", "schema"])


def foreign_schemas(spark: SparkSession, path: str) -> DataFrame:
    """``folder, path, schema`` of every Parquet file below ``path``; footers are read in tasks."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    names = found.select("path").repartition(spark.sparkContext.defaultParallelism * 4)
    return names.mapInArrow(_footer_rows, "folder string, path string, schema string")


def reconcile(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """Read files whose schemas differ, by column name, as the contract's types.

    Files with the same schema are read together by Spark's own reader, with its column pruning, splitting and
    file systems, and the groups are put together. Missing columns and columns without any value become
    nulls; decimals of any precision and scale are rounded to the contract, numbers out of its range are null.
    Footers are read in tasks and grouped there. What reaches the driver are the distinct schemas, the folders
    whose files agree, and the names of files in folders whose files do not.
    """
    footers = stored(foreign_schemas(spark, path), "footers")
    per_folder = footers.groupBy("folder").agg(F.min("schema").alias("low"), F.max("schema").alias("high"))
    agreed = per_folder.filter("low = high").select(F.col("low").alias("schema"), F.concat("folder", F.lit("/*.parquet")).alias("source"))
    mixed = per_folder.filter("low <> high").select(F.col("folder").alias("_mixed"))
    single = footers.join(mixed, F.col("folder") == F.col("_mixed")).select("schema", F.col("path").alias("source"))
    groups = agreed.unionByName(single).groupBy("schema").agg(F.sort_array(F.collect_list("source")).alias("sources")).collect()
    parts = [
        _as_contract(spark.read.schema(T.StructType.fromJson(json.loads(g["schema"]))).parquet(*g["sources"]), contract)
        for g in sorted(groups, key=lambda g: g["schema"])
    ]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], contract))
