"""Union of several eras of the same data set."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType, StructType, TimestampType)

from .columns import trim_names


_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def common_type(name: str, types: Sequence[DataType]) -> DataType:
    """The type that holds all values of the given ones: the widest number
    type, or a timestamp for dates and timestamps. Raises if there is none, as
    for numbers and text: which of the two is meant must be declared."""
    kinds = list(dict.fromkeys(types))
    if len(kinds) == 1:
        return kinds[0]
    if all(isinstance(t, _WHOLE) for t in kinds):
        return max(kinds, key=lambda t: next(k for k, c in enumerate(_WHOLE) if isinstance(t, c)))
    if all(isinstance(t, (*_WHOLE, DecimalType)) for t in kinds):
        digits = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
        scale = max(getattr(t, "scale", 0) for t in kinds)
        whole = max(t.precision - t.scale if isinstance(t, DecimalType) else digits[type(t)] for t in kinds)
        if whole + scale <= 38:
            return DecimalType(whole + scale, scale)
    elif all(isinstance(t, (ByteType, ShortType, IntegerType, FloatType, DoubleType)) for t in kinds):
        return DoubleType()
    elif all(isinstance(t, (DateType, TimestampType)) for t in kinds):
        return TimestampType()
    raise TypeError(f"column {name}: {' and '.join(t.simpleString() for t in kinds)} have no common type; declare one")


def reconcile(frames: Sequence[DataFrame], declared: StructType | str | None = None) -> list[DataFrame]:
    """The frames with one type per column name: the declared one, else the
    common one of the frames that have the column (see :func:`common_type`).
    This is settled while planning. Only values of a declared type can fail to
    fit; they become NULL, and :func:`misfits` counts them."""
    declared = StructType.fromDDL(declared) if isinstance(declared, str) else declared
    target = {f.name: f.dataType for f in declared.fields} if declared is not None else {}
    names = dict.fromkeys(f.name for df in frames for f in df.schema.fields)
    for name in names:
        if name not in target:
            target[name] = common_type(name, [df.schema[name].dataType for df in frames if name in df.columns])
    same = lambda df: all(f.dataType == target[f.name] for f in df.schema.fields)
    return [df if same(df) else df.select([
        F.col(f"`{f.name}`") if f.dataType == target[f.name] else F.col(f"`{f.name}`").try_cast(target[f.name]).alias(f.name)
        for f in df.schema.fields]) for df in frames]


def misfits(frame: DataFrame, declared: StructType | str) -> DataFrame:
    """One row: per declared column of the frame, how many of its values do not
    fit the declared type."""
    declared = StructType.fromDDL(declared) if isinstance(declared, str) else declared
    return frame.select([F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f.name)
                         for f in declared.fields if f.name in frame.columns])


def union_eras(*frames: DataFrame, allow_missing: bool = False, types: StructType | str | None = None) -> DataFrame:
    """Trim names of every frame and union them by name (bag union, duplicates kept).

    With ``allow_missing=False`` differing name sets raise, which is how a
    renamed column is caught early. Columns whose types differ between the eras
    are brought to one type, ``types`` naming those that have no common one.
    """
    if not frames:
        raise ValueError("union_eras needs at least one frame")
    trimmed = reconcile([trim_names(f) for f in frames], types)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), trimmed)
