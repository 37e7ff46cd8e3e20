"""Targets of the staging job: replacing a table or a path, and appending missing rows.

A replacement writes the new version whole before anything else changes, so a failing write
leaves the old rows as they are:

* A catalog table keeps its name, types, partitioning and provider. The new version goes to a
  folder of its own beside the old one, with the table's columns and types by name. An
  unpartitioned table's location is then switched in one catalog operation. A partitioned table
  has a location for each partition: partitions of both versions are pointed to the new folder,
  new ones are added and the others dropped, by catalog operations alone; if one of them fails,
  those before it are undone. Last, the old version's files are deleted.
* A plain path is swapped by two renames (old away, new in place; if the second fails the first
  is undone); between the two a reader finds no folder.
* A versioned path holds its versions in folders below it, and a pointer for each version. A
  pointer is written only when its version is complete, in one step (a rename to a name that is
  new, so it holds for object stores too). :func:`read_versioned` reads the version of the latest
  pointer. The version before it is kept until the next replacement, for readers that have begun.

An append adds only rows whose key the target doesn't hold (an anti join with the target as it is
now), so a second run, or one after a half failed one, adds what is missing and nothing else.
"""

from __future__ import annotations

import dataclasses
import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagecraft.sources.params import ParameterError

# Versions of a versioned path that stay after a replacement: the current one and the one before.
KEPT_VERSIONS = 2
# Fixed value: the directory name of a partition whose value is null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_VERSION_MARK = re.compile(r"-v[0-9a-f]{32}$")


# -- files ----------------------------------------------------------------------
def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as its object."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def delete_path(spark: SparkSession, path: str) -> None:
    files, at = file_system(spark, path)
    files.delete(at, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no folder."""
    files, at = file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears with its whole content: written aside, then renamed to a new name."""
    files, at = file_system(spark, path)
    folder, name = path.rsplit("/", 1)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = files.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not files.rename(aside, at):
        files.delete(aside, False)
        raise OSError(f"cannot create {path}")


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    files, at = file_system(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


# -- reading --------------------------------------------------------------------
def exists(spark: SparkSession, target: str, fmt: str) -> bool:
    if fmt == "table":
        return spark.catalog.tableExists(target)
    files, path = file_system(spark, target)
    return files.exists(path)


def is_versioned(spark: SparkSession, target: str) -> bool:
    return exists(spark, f"{target.rstrip('/')}/_versions", "path")


def read_table(spark: SparkSession, target: str, fmt: str) -> DataFrame:
    """A catalog table, a plain path, or the current version of a versioned one."""
    if fmt == "table":
        return spark.table(target)
    if is_versioned(spark, target):
        return read_versioned(spark, target, fmt)
    return spark.read.format(fmt).load(target)


def matched_to(df: DataFrame, target: DataFrame) -> DataFrame:
    """``df`` with the columns and types of ``target``, by name; a column that ``df`` lacks is
    null, one that ``target`` lacks is an error."""
    unknown = [c for c in df.columns if c not in target.columns]
    if unknown:
        raise ParameterError(f"columns unknown to the target table: {', '.join(unknown)}")
    mine = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in mine else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema])


# -- catalog tables ---------------------------------------------------------------
@dataclasses.dataclass(frozen=True)
class CatalogTable:
    """What a replacement keeps of a table."""

    name: str
    location: str
    provider: str
    partitioning: list[str]

    @classmethod
    def of(cls, spark: SparkSession, name: str) -> CatalogTable:
        told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        partitioning = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        return cls(name, told["Location"].rstrip("/"), told["Provider"], partitioning)

    def partitions(self, spark: SparkSession) -> dict[str, str]:
        """Location of each partition, by its directory name (``a=1/b=x``)."""
        found = {}
        for row in spark.sql(f"SHOW PARTITIONS {self.name}").collect():
            told = spark.sql(f"DESCRIBE TABLE EXTENDED {self.name} PARTITION ({partition_sql(row[0])})").collect()
            found[row[0]] = next(r["data_type"] for r in told if r["col_name"] == "Location")
        return found


def partition_sql(directory: str) -> str:
    """The partition of a directory name, as SQL's ``a = '1', b = 'x'``."""
    parts = []
    for part in directory.split("/"):
        column, _, value = part.partition("=")
        value = unquote(value)
        shown = "null" if value == NULL_PARTITION else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        parts.append(f"`{unquote(column)}` = {shown}")
    return ", ".join(parts)


def _partition_folders(spark: SparkSession, home: str, depth: int) -> list[str]:
    """Directory names of the partitions of a written version, relative to its folder."""
    found = [""]
    for _ in range(depth):
        found = [f"{up}{name}/" for up in found for name in list_names(spark, f"{home}/{up}") if "=" in name]
    return [f.rstrip("/") for f in found]


def _literal(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _replace_catalog_table(df: DataFrame, name: str) -> None:
    spark = df.sparkSession
    table = CatalogTable.of(spark, name)
    home = f"{_VERSION_MARK.sub('', table.location)}-v{uuid.uuid4().hex}"
    try:
        matched_to(df, spark.table(name)).write.format(table.provider).partitionBy(*table.partitioning).save(home)
    except BaseException:
        delete_path(spark, home)
        raise
    old = table.partitions(spark) if table.partitioning else {}
    if table.partitioning:
        _switch_partitions(spark, table, old, home)
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_literal(home)}")
    spark.catalog.refreshTable(name)
    for folder in {table.location, *old.values()}:
        delete_path(spark, folder)


def _switch_partitions(spark: SparkSession, table: CatalogTable, old: dict[str, str], home: str) -> None:
    """Point the table's partitions to the version in ``home``; on a failure, back to the old ones."""
    new = {p: f"{home}/{p}" for p in _partition_folders(spark, home, len(table.partitioning))}
    one = lambda p: f"PARTITION ({partition_sql(p)})"
    # (what to do, what undoes it); added partitions show with the first that is switched.
    steps = [(f"SET LOCATION {_literal(home)}", f"SET LOCATION {_literal(table.location)}")]
    steps += [
        (f"{one(p)} SET LOCATION {_literal(at)}", f"{one(p)} SET LOCATION {_literal(old[p])}") for p, at in new.items() if p in old
    ]
    # Partitions without rows in the new version are emptied before they are dropped: a table that
    # owns its files would otherwise delete those that an undone switch needs.
    empty = f"{home}/_empty"
    files, at = file_system(spark, empty)
    files.mkdirs(at)
    gone = [p for p in old if p not in new]
    steps += [(f"{one(p)} SET LOCATION {_literal(empty)}", f"{one(p)} SET LOCATION {_literal(old[p])}") for p in gone]
    added = [p for p in new if p not in old]
    if added:
        steps.append(
            (
                "ADD IF NOT EXISTS " + " ".join(f"{one(p)} LOCATION {_literal(new[p])}" for p in added),
                f"DROP IF EXISTS {', '.join(map(one, added))}",
            )
        )
    done: list[str] = []
    try:
        for do, undo in steps:
            spark.sql(f"ALTER TABLE {table.name} {do}")
            done.append(undo)
    except BaseException:
        for undo in reversed(done):
            spark.sql(f"ALTER TABLE {table.name} {undo}")
        delete_path(spark, home)
        raise
    if gone:
        spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS {', '.join(map(one, gone))}")
    delete_path(spark, empty)


# -- paths ------------------------------------------------------------------------
def _swap_path(df: DataFrame, target: str, fmt: str) -> None:
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    new, old = f"{target.rstrip('/')}-new-{mark}", f"{target.rstrip('/')}-old-{mark}"
    try:
        df.write.format(fmt).save(new)
    except BaseException:
        delete_path(spark, new)
        raise
    files, path = file_system(spark, target)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    had = files.exists(path)
    if had and not files.rename(path, path_of(old)):
        raise OSError(f"cannot move {target} aside; the new result is in {new}")
    if not files.rename(path_of(new), path):
        if had:
            files.rename(path_of(old), path)
        raise OSError(f"cannot move {new} to {target}")
    if had:
        files.delete(path_of(old), True)


def _pointers(spark: SparkSession, target: str) -> list[str]:
    """Names of the complete versions of a versioned path, oldest first."""
    return [n for n in list_names(spark, f"{target.rstrip('/')}/_versions/_pointers") if not n.startswith(".")]


def replace_versioned(df: DataFrame, target: str, fmt: str) -> str:
    """Write ``df`` as the next version of a versioned path and point to it; returns its folder."""
    spark = df.sparkSession
    home = f"{target.rstrip('/')}/_versions"
    if exists(spark, target, fmt) and not is_versioned(spark, target) and list_names(spark, target):
        raise ParameterError(f"{target} holds rows outside of versions")
    before = _pointers(spark, target)
    version = f"{int(before[-1].split('-')[0]) + 1 if before else 1:012d}-{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).save(f"{home}/{version}")
    except BaseException:
        delete_path(spark, f"{home}/{version}")
        raise
    files, pointers = file_system(spark, f"{home}/_pointers")
    files.mkdirs(pointers)
    write_file(spark, f"{home}/_pointers/{version}", version)
    # Older versions go: their pointers first, so that no reader is sent to a folder that goes.
    stale = _pointers(spark, target)[:-KEPT_VERSIONS]
    for name in stale:
        delete_path(spark, f"{home}/_pointers/{name}")
    for name in stale:
        delete_path(spark, f"{home}/{name}")
    return f"{home}/{version}"


def read_versioned(spark: SparkSession, target: str, fmt: str) -> DataFrame:
    """The latest complete version of a versioned path."""
    found = _pointers(spark, target)
    if not found:
        raise ParameterError(f"{target} has no complete version")
    return spark.read.format(fmt).load(f"{target.rstrip('/')}/_versions/{found[-1]}")


# -- the operations -----------------------------------------------------------------
def replace_table(df: DataFrame, target: str, fmt: str, versioned: bool = False, partition_by: Sequence[str] = ()) -> None:
    """Replace ``target`` (a path, or a table name when ``fmt`` is ``"table"``) by ``df``.

    ``versioned`` makes a path that doesn't exist yet a versioned one; a path that is one stays
    one. ``partition_by`` holds for a table that doesn't exist yet."""
    spark = df.sparkSession
    if fmt != "table":
        if versioned or is_versioned(spark, target):
            replace_versioned(df, target, fmt)
        else:
            _swap_path(df, target, fmt)
    elif exists(spark, target, fmt):
        _replace_catalog_table(df, target)
    else:
        df.write.partitionBy(*partition_by).saveAsTable(target)


def missing_rows(df: DataFrame, target: DataFrame, keys: Sequence[str], within: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``keys`` no row of ``target`` has. Keys are compared as the scans read
    them: strings without blanks at their end, dates and timestamps as dates. ``within`` is a
    condition on the target that all keys of ``df`` meet; it is pushed into the scan."""

    def key(frame: DataFrame, column: str):
        kind = frame.schema[column].dataType.typeName()
        c = F.col(column)
        return F.rtrim(c) if kind == "string" else F.to_date(c) if kind in ("date", "timestamp", "timestamp_ntz") else c

    held = target.where(within) if within else target
    held = held.select(*[key(target, k).alias(f"_held_{i}") for i, k in enumerate(keys)])
    same = [key(df, k) == F.col(f"_held_{i}") for i, k in enumerate(keys)]
    return df.join(held, same, "left_anti")


def append_rows(df: DataFrame, target: str, fmt: str) -> None:
    if fmt == "table" and exists(df.sparkSession, target, fmt):
        matched_to(df, df.sparkSession.table(target)).write.insertInto(target)  # partitioned or not
    elif fmt == "table":
        df.write.saveAsTable(target)
    elif is_versioned(df.sparkSession, target):
        raise ParameterError(f"{target} holds versions, which are replaced and not appended to")
    else:
        df.write.mode("append").format(fmt).save(target)


def append_missing(df: DataFrame, target: str, fmt: str, keys: Sequence[str], within: str | None = None) -> None:
    """Append the rows of ``df`` whose keys ``target`` doesn't hold, with the target's column types.
    A target that doesn't exist is created."""
    spark = df.sparkSession
    if exists(spark, target, fmt):
        held = read_table(spark, target, fmt)
        df = matched_to(missing_rows(df, held, keys, within), held)
    append_rows(df, target, fmt)
