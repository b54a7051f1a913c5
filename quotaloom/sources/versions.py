"""Committed versions of a warehouse folder: readers see a whole refresh or the one before it, never half of one.

``<root>/data/<run>/<table>`` holds what a run wrote; ``<root>/_commits/<number>.json`` lists the folders that make up a
version. A run becomes visible by one rename, of its commit file to the next free number. The rename refuses to replace
a file, so of two runs that started from the same version one fails and publishes nothing. A run that dies before that leaves
the last version as it was. A table of a version may have several folders (appended loads).

Needs a file system whose rename is atomic (HDFS and the like; on a plain object store, let one writer run at a time).
Folders without commits are read as they stand.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from . import sinks
from .landing import read_processed
from .schemas import PARTITIONS


class ConcurrentLoad(RuntimeError):
    """Another run committed first; nothing of this one is visible."""


@dataclass(frozen=True)
class Version:
    number: int
    fmt: str
    tables: Mapping[str, Sequence[str]]  # folders below the root, by table
    rejects: Mapping[str, str] = field(default_factory=dict)  # parquet folders of rejected records, by name

    def folders(self, root: str, table: str) -> list[str]:
        return [f"{root.rstrip('/')}/{f}" for f in self.tables[table]]


def _path(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _commit_file(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/_commits/{number:012d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, ascending."""
    folder, fs = _path(spark, f"{root.rstrip('/')}/_commits")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def at(spark: SparkSession, root: str, number: int) -> Version:
    p, fs = _path(spark, _commit_file(root, number))
    stream = fs.open(p)
    try:
        said = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, said["fmt"], said["tables"], said["rejects"])


def current(spark: SparkSession, root: str) -> Version | None:
    """The last committed version; None for a folder without commits."""
    numbers = versions(spark, root)
    return at(spark, root, numbers[-1]) if numbers else None


def new_run() -> str:
    """A fresh folder, below the root, for a run to write its tables in."""
    return f"data/{uuid.uuid4().hex}"


def commit(
    spark: SparkSession, root: str, base: Version | None, fmt: str, tables: Mapping[str, Sequence[str]], rejects: Mapping[str, str] | None = None
) -> Version:
    """Publish ``tables`` (and the rejected records of their extracts) as the version after ``base``."""
    rejects = dict(rejects or {})
    number = base.number + 1 if base else 1
    temporary, fs = _path(spark, f"{root.rstrip('/')}/_commits/.{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    out.write(json.dumps({"fmt": fmt, "tables": {k: list(v) for k, v in tables.items()}, "rejects": rejects}).encode())
    out.close()
    final, _ = _path(spark, _commit_file(root, number))
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)  # do not replace
    try:
        files.rename(temporary, final, plain)
    except Exception as e:
        fs.delete(temporary, False)
        if "FileAlreadyExists" in str(e):
            raise ConcurrentLoad(f"version {number} of {root} was committed by another run") from e
        raise
    return Version(number, fmt, dict(tables), rejects)


def read_rejected(spark: SparkSession, root: str, version: Version, extract: str) -> DataFrame | None:
    """The records that the version's run rejected of an extract; None if it rejected none."""
    folder = version.rejects.get(f"rejected_{extract}")
    return spark.read.parquet(f"{root.rstrip('/')}/{folder}") if folder else None


def discard(spark: SparkSession, root: str, run: str) -> None:
    """Delete what an unpublished run wrote."""
    p, fs = _path(spark, f"{root.rstrip('/')}/{run}")
    fs.delete(p, True)


def read(spark: SparkSession, root: str, version: Version, table: str) -> DataFrame:
    """A table of a version; later folders' rows follow the earlier ones'."""
    out = None
    for folder in version.tables[table]:
        parent = folder.rsplit("/", 1)[0]
        df = read_processed(spark, f"{root.rstrip('/')}/{parent}", table, version.fmt)
        out = df if out is None else out.unionByName(df)
    return out


def load(spark: SparkSession, df: DataFrame, root: str, table: str, mode: str = "replace", fmt: str = "parquet") -> Version:
    """IO5: load one table and commit: ``replace`` it, ``append`` to it, or ``fail`` if the current version has it.

    The other tables are those of the version before. The format of a warehouse is that of its first version.
    """
    base = current(spark, root)
    have = list(base.tables.get(table, ())) if base else []
    if mode not in ("replace", "append", "fail"):
        raise ValueError(f"unknown load mode {mode!r}")
    if mode == "fail" and have:
        raise ValueError(f"{table} exists in version {base.number} of {root}")
    fmt, run = base.fmt if base else fmt, new_run()
    try:
        sinks.write_table(df, f"{root.rstrip('/')}/{run}/{table}", "fail", fmt, PARTITIONS.get(table))
        kept = have if mode == "append" else []
        return commit(spark, root, base, fmt, {**(base.tables if base else {}), table: [*kept, f"{run}/{table}"]}, base.rejects if base else None)
    except BaseException:
        discard(spark, root, run)
        raise


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Forget all but the last ``keep`` versions: their commit files, and folders that no kept version lists.

    Folders of unpublished runs are left alone: such a run may still be writing.
    """
    if keep < 1:
        raise ValueError("keep at least the current version")
    numbers = versions(spark, root)
    old, kept = numbers[:-keep], numbers[-keep:]
    lists = lambda v: {f for folders in v.tables.values() for f in folders} | set(v.rejects.values())
    used = set().union(*(lists(at(spark, root, n)) for n in kept)) if kept else set()
    for n in old:
        unused = lists(at(spark, root, n)) - used
        p, fs = _path(spark, _commit_file(root, n))
        fs.delete(p, False)
        for f in sorted(unused):
            discard(spark, root, f)
    return old
