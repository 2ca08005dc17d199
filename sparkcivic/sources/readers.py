"""Readers for Parquet, delimited text and plain text lines."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.union import reconcile

BAD_CELLS, BAD_LINE = "_bad_cells", "_bad_line"

def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_parquet(spark: SparkSession, paths, columns: Sequence[str] | None = None, schema: StructType | str | None = None,
                 merge_schema: bool = False) -> DataFrame:
    """Columnar scan; selecting ``columns`` here (or later) prunes the read.

    Several paths may have different layouts: each is read with its own, and
    the rows are united by column name, with NULL where a path has no such
    column. Types that differ are reconciled as in ``union_eras``: to a common
    number type, or to the type that ``schema`` declares, else it is an error.
    With a ``schema`` the result has its columns, in its order, and a column
    that no path has is an error. ``merge_schema`` does the same for the files
    of one path, at the cost of reading all their footers.
    """
    want = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    frames = [spark.read.option("mergeSchema", merge_schema).parquet(p) for p in _paths(paths)]
    if want is not None:
        missing = [f.name for f in want.fields if all(f.name not in df.columns for df in frames)]
        if missing:
            raise ValueError(f"no path has column {', '.join(missing)}")
        frames = [df.select(*[f"`{f.name}`" for f in want.fields if f.name in df.columns]) for df in frames]
    df = frames[0] if len(frames) == 1 and want is None else reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), reconcile(frames, want))
    if want is not None:
        df = df.select(*[f"`{f.name}`" for f in want.fields])
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, paths, schema: StructType | str | None = None,
             header: bool = True, multi_line: bool = False, infer: bool = False,
             sep: str = ",", mode: str = "PERMISSIVE") -> DataFrame:
    """Delimited text with a declared schema (inference only when ``infer``).

    With a header, declared columns are found by their (trimmed) names, in any
    order and among others; a missing one is an error, and so is a file of the
    same path whose header differs. Several paths may differ from each other.
    Without a header, the schema is bound by position.

    Quotes inside quoted fields are escaped by doubling (``escape='"'``).
    ``multi_line=True`` accepts newlines inside quoted fields but makes every
    file a single split, so it is off by default: at scale a file must be
    splittable across many tasks.
    """
    reader = (spark.read.option("header", header).option("sep", sep).option("escape", '"')
              .option("multiLine", multi_line).option("mode", mode))
    if schema is None:
        return reader.option("inferSchema", infer).csv(_paths(paths))
    if not header:
        return reader.schema(schema).csv(_paths(paths))
    want = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    frames = [_by_header(reader, p, want) for p in _paths(paths)]
    return reduce(lambda a, b: a.unionByName(b), frames)


def _by_header(reader, path: str, want: StructType, bad_line: str | None = None) -> DataFrame:
    names = reader.csv(path).columns  # reads one line
    trimmed = [n.strip() for n in names]
    missing = [f.name for f in want.fields if f.name not in trimmed]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header")
    types = {f.name: f.dataType for f in want.fields}
    schema = StructType([StructField(n, types.get(t, StringType())) for n, t in zip(names, trimmed)])
    more = [StructField(bad_line, StringType())] if bad_line else []
    df = reader.option("enforceSchema", False).schema(StructType([*schema.fields, *more])).csv(path)
    return df.select([F.col(f"`{names[trimmed.index(f.name)]}`").alias(f.name) for f in want.fields] + [f.name for f in more])


def read_csv_checked(spark: SparkSession, paths, schema: StructType | str, header: bool = True, multi_line: bool = False,
                     sep: str = ",") -> DataFrame:
    """Delimited text with a declared schema in which nothing is lost unseen.

    The declared columns, typed, and beside each of them that is no text its
    text as ``_text_<name>``; ``_bad_cells``: names of the columns whose text
    is not empty and does not fit the type; ``_bad_line``: the line, if it has
    more or fewer fields than the others. Cells that do not fit are NULL.
    """
    want = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    reader = (spark.read.option("header", header).option("sep", sep).option("escape", '"').option("multiLine", multi_line)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE))
    texts = StructType([StructField(f.name, StringType()) for f in want.fields])
    if header:
        frames = [_by_header(reader, p, texts, BAD_LINE) for p in _paths(paths)]
    else:
        frames = [reader.schema(StructType([*texts.fields, StructField(BAD_LINE, StringType())])).csv(_paths(paths))]
    df = reduce(lambda a, b: a.unionByName(b), frames)
    typed, kept, bad = [], [], []
    for f in want.fields:
        text, value = F.col(f"`{f.name}`"), F.col(f"`{f.name}`").try_cast(f.dataType)
        typed.append(value.alias(f.name))
        if f.dataType != StringType():
            kept.append(text.alias(f"_text_{f.name}"))
            bad.append(F.when(value.isNull() & (F.trim(text) != ""), F.lit(f.name)))
    cells = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return df.select(*typed, *kept, cells.alias(BAD_CELLS), BAD_LINE)


def read_text(spark: SparkSession, paths) -> DataFrame:
    """One row per line in a single ``value`` column."""
    return spark.read.text(_paths(paths))


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line`` (from 1, over the files in the order of their names) and
    ``value``: an ordered result as its reader sees it. Every file is one row
    on the way, so this is for results, not for raw data."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), F.split(F.regexp_replace("value", "\\r?\\n$", ""), "\\r?\\n").alias("lines")).where("lines <> array('')")
    start = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one small row a file
    before = files.select("file", F.size("lines").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(start), F.lit(0)))
    return files.join(before, "file").select("before", F.posexplode("lines").alias("at", "value")).select(
        (F.col("before") + F.col("at") + 1).cast("bigint").alias("line"), "value")


def parse_csv_lines(lines: DataFrame, schema: StructType, header: str | None = None,
                    required: Sequence[str] = (), value_col: str = "value") -> DataFrame:
    """Typed rows from CSV text lines (quoted separators handled by ``from_csv``).

    Lines equal to ``header`` are dropped wherever they occur (a header
    repeated by every input file). Fields listed in ``required`` must be
    present and non-empty; short lines give NULL trailing fields and so are
    dropped by that test. Fields that do not fit their type become NULL.
    """
    v = F.col(value_col)
    if header is not None:
        lines = lines.filter(v != header)
    # parse every field as text first, so the emptiness test sees '' and
    # typing happens afterwards with try_cast (dirty values become NULL)
    ddl = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    parsed = lines.select(F.from_csv(v, ddl, {"escape": '"'}).alias("_r"))
    texts = parsed.select([F.col("_r").getField(f.name).alias(f.name) for f in schema.fields])
    for r in required:
        texts = texts.filter(F.col(f"`{r}`").isNotNull() & (F.col(f"`{r}`") != ""))
    return texts.select([F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
