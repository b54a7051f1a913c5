"""Sinks (IO2, IO3, IO5, IO9–IO12): tables and exports written by Spark executors.

Nothing passes through the driver: every writer is ``DataFrame.write``. Load modes follow
the reference's names: replace → overwrite, append → append, fail → errorifexists.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from .schemas import CSV

MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists",
         "overwrite": "overwrite", "errorifexists": "errorifexists", "ignore": "ignore"}


def write_table(df: DataFrame, path: str, mode: str = "replace", fmt: str = "parquet",
                partition_by: Sequence[str] | None = None) -> None:
    """IO3/IO5: one table to ``path`` (parquet by default; csv with a header row).

    Partitioned writes first ask AQE to rebalance on the partition columns: files come out
    near the advisory size, a month is not spread over every writer task, and a hot month
    is split rather than written by one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(MODES[mode]).format(fmt)
    if fmt == "csv":
        w = w.options(**CSV)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_as_table(df: DataFrame, name: str, mode: str = "replace", fmt: str = "parquet") -> None:
    """IO5 into the session catalog (managed table)."""
    df.write.mode(MODES[mode]).format(fmt).saveAsTable(name)


def write_csv(df: DataFrame, path: str, mode: str = "replace") -> None:
    """IO2/IO9/IO10: CSV with a header row (one directory of part files per dataset)."""
    df.write.mode(MODES[mode]).options(**CSV).csv(path)


def publish(datasets: Mapping[str, DataFrame], root: str, fmt: str = "csv", mode: str = "replace") -> list[str]:
    """IO11/IO12: a set of named result datasets under one folder."""
    paths = []
    for name, df in datasets.items():
        path = f"{root.rstrip('/')}/{name}"
        write_table(df, path, mode, fmt)
        paths.append(path)
    return paths
