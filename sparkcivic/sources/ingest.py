"""Batch ingest of a catalogue of raw sources into Parquet.

Sources are independent and are read at the same time by a few threads. Each is
written to a folder of its own beside the target, its rows are counted while
they are written and once more in what was written, and only then does it take
the target's place; the table of the day before stays readable until that
moment, and stays for good if the source fails. Two renames take the old table
away and put the new one there: on HDFS and local disks each is atomic, on an
object store a rename copies, so tables there should be read through a catalogue.

Rows of a declared CSV source with a cell that does not fit its column, or with
a wrong number of fields, are kept out of the table. They are counted in the
status and written, as texts, to ``_rejected/<name>``.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from ..session import delete_paths, switch
from .readers import BAD_CELLS, BAD_LINE, read_csv, read_csv_checked, read_parquet, read_text
from .sinks import write_parquet

AT_ONCE = 4  # sources that are loaded at the same time

STATUS_SCHEMA = StructType([
    StructField("source", StringType(), False),
    StructField("rows", LongType(), True),
    StructField("rejected", LongType(), True),
    StructField("ok", BooleanType(), False),
    StructField("error", StringType(), True),
    StructField("message", StringType(), True),
])


@dataclass
class Source:
    name: str
    path: str | list[str]
    fmt: str = "csv"                       # csv | text | parquet
    schema: StructType | None = None
    transform: Callable[[DataFrame], DataFrame] | None = None
    options: dict = field(default_factory=dict)


def _read(spark: SparkSession, src: Source) -> DataFrame:
    if src.fmt == "csv":
        return read_csv(spark, src.path, schema=src.schema, infer=src.schema is None, **src.options)
    if src.fmt == "text":
        return read_text(spark, src.path)
    if src.fmt == "parquet":
        return read_parquet(spark, src.path, schema=src.schema)
    raise ValueError(f"unknown format {src.fmt!r}")


def _error_name(exc: Exception) -> str:
    cond = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
    try:
        name = cond() if cond else None
    except Exception:  # pragma: no cover - defensive
        name = None
    return name or type(exc).__name__


def _error_message(exc: Exception) -> str:
    """First line of the message, without the name of its condition."""
    lines = str(exc).strip().splitlines()
    return re.sub(r"^\[[A-Z0-9_.]+\] ", "", lines[0]) if lines else ""


def _bad() -> Column:
    return (F.size(BAD_CELLS) > 0) | F.col(BAD_LINE).isNotNull()


def _rejected(checked: DataFrame, schema: StructType) -> DataFrame:
    """The bad rows with all cells as they were."""
    texts = [F.col(f"`{f.name}`") if f.dataType == StringType() else F.col(f"`_text_{f.name}`").alias(f.name) for f in schema.fields]
    return checked.where(_bad()).select(*texts, BAD_CELLS, BAD_LINE)


def _load(spark: SparkSession, src: Source, out_root: str, run: str) -> tuple:
    """Writes one source beside its target and switches; (rows, rejected)."""
    staged, target, rejects = (f"{out_root}/{p}" for p in (f"_staged/{src.name}-{run}", src.name, f"_rejected/{src.name}"))
    seen, kept = Observation(), Observation()
    checked = None
    try:
        if src.fmt == "csv" and src.schema is not None:
            checked = read_csv_checked(spark, src.path, src.schema, **src.options)
            df = checked.observe(seen, F.count_if(_bad()).alias("rejected")).where(~_bad()).select(*[f"`{f.name}`" for f in src.schema.fields])
        else:
            df = _read(spark, src)
        if src.transform is not None:
            df = src.transform(df)
        write_parquet(df.observe(kept, F.count(F.lit(1)).alias("rows")), staged)
        rows, rejected = kept.get["rows"], seen.get["rejected"] if checked is not None else 0
        written = spark.read.parquet(staged).count()
        if written != rows:
            raise IOError(f"{src.name}: {rows} rows read, {written} written")
        if rejected:
            write_parquet(_rejected(checked, src.schema), f"{staged}-rejected")
        switch(spark, staged, target)
        if rejected:
            switch(spark, f"{staged}-rejected", rejects)
        else:
            delete_paths(spark, [rejects])
        return rows, rejected
    finally:
        delete_paths(spark, [staged, f"{staged}-rejected"])


def ingest(spark: SparkSession, catalogue: list[Source], out_root: str, at_once: int = AT_ONCE) -> DataFrame:
    """Write every source to ``out_root/<name>`` as Parquet.

    A failing source is reported, leaves its earlier table as it was, and the
    others continue. Returns one status row per source, in the order of the
    catalogue: ``source, rows, rejected, ok, error, message``.
    """
    names = [src.name for src in catalogue]
    if len(set(names)) < len(names) or any(n.startswith(("_", ".")) or "/" in n for n in names):
        raise ValueError("source names must differ and be plain folder names")
    root, run = out_root.rstrip("/"), uuid.uuid4().hex[:12]

    def load(src: Source) -> tuple:
        try:
            rows, rejected = _load(spark, src, root, run)
            return src.name, rows, rejected, True, None, None
        except Exception as exc:  # one bad source must not stop the batch
            return src.name, None, None, False, _error_name(exc), _error_message(exc)
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        status = list(pool.map(load, catalogue))
    return spark.createDataFrame(status, STATUS_SCHEMA)
