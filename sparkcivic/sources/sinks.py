"""Writers. Results are written by many tasks unless ``single_file`` is asked for.

``order_by`` gives the output a total order: rows are dealt to the tasks by
range and sorted inside each, so the part files, read by name, are in order;
a single file is sorted by the one task that writes it. ``balanced`` lets
Spark even out the files: small ones are merged and a value with many rows is
split, also below ``partition_by``.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Order = Sequence[str | Column]


def _dealt(df: DataFrame, single_file: bool, order_by: Order = (), parts: int | None = None) -> DataFrame:
    # one output file means one writing task: only for small, bounded results;
    # an exchange keeps the upstream plan in its own tasks
    if single_file:
        df = df.repartition(1)
    elif order_by:
        df = df.repartitionByRange(parts, *order_by) if parts else df.repartitionByRange(*order_by)
    return df.sortWithinPartitions(*order_by) if order_by else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None, single_file: bool = False, balanced: bool = False,
                  order_by: Order = (), parts: int | None = None) -> str:
    if balanced:
        if single_file or order_by:
            raise ValueError("balanced files have no order, and are several")
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by or ()])
    w = _dealt(df, single_file, order_by, parts).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
              single_file: bool = False, sep: str = ",", order_by: Order = (), parts: int | None = None) -> str:
    (_dealt(df, single_file, order_by, parts).write.mode(mode).option("header", header).option("sep", sep)
     .option("escape", '"').csv(path))
    return path


def write_text(df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False, order_by: Order = (),
               parts: int | None = None) -> str:
    """One line per row of a single string column. The default mode refuses
    an existing path, like saving an RDD as text."""
    if len(df.columns) != 1:
        raise ValueError("write_text needs exactly one string column")
    _dealt(df, single_file, order_by, parts).write.mode(mode).text(path)
    return path


def write_bucketed(df: DataFrame, path: str, key: str | Sequence[str], buckets: int, name: str | None = None) -> DataFrame:
    """A Parquet table at ``path`` whose files are divided by ``key``, one sorted
    file a bucket, and a frame that reads it.

    Tables with the same keys and number of buckets are joined or grouped on
    the key bucket by bucket, without a shuffle, as often as they are read.
    That pays for large tables joined more than once. A bucket is read by one
    task, so ``buckets`` should follow the size, and a key with a large share
    of the rows is better joined by shuffle, where Spark can split it.

    The table is registered in the session's catalogue as ``name`` (a fresh one
    if not given); its files belong to the caller, who deletes the folder.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not keys or buckets < 1:
        raise ValueError("write_bucketed needs a key and at least one bucket")
    name = name or f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, *[F.col(f"`{k}`") for k in keys]).write.format("parquet").mode("overwrite").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return df.sparkSession.table(name)
