"""Objects whose keys are data: read as maps, exploded to rows or pivoted to a bounded list of columns."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from hitloom.operators.columns import flat, quoted, require_unique

#: Columns that a map may be pivoted to.
MAX_KEYS = 1_000


def map_columns(df: DataFrame) -> list[str]:
    """Names of the columns that hold maps."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, MapType)]


def _common(a: DataType, b: DataType) -> DataType:
    """A type that holds the values of both, as JSON inference would choose it."""
    if a == b:
        return a
    if isinstance(a, StructType) and isinstance(b, StructType):
        fields = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            fields[f.name] = _common(fields[f.name], f.dataType) if f.name in fields else f.dataType
        return StructType([StructField(name, fields[name]) for name in sorted(fields)])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(_common(a.elementType, b.elementType))
    numbers = (LongType, DoubleType, DecimalType)
    return DoubleType() if isinstance(a, numbers) and isinstance(b, numbers) else StringType()


def objects_as_maps(schema: StructType, names: Collection[str]) -> StructType:
    """A schema for reading the objects called ``names`` (flat names) as maps from text to one type of value.

    Objects inside arrays are named as unpacking would name them. A name that is no
    object of the schema raises ``ValueError``.
    """
    found: set[str] = set()

    def walk(name: str, dtype: DataType) -> DataType:
        if isinstance(dtype, ArrayType):
            return ArrayType(walk(name, dtype.elementType), dtype.containsNull)
        if not isinstance(dtype, StructType):
            return dtype
        prefix = f"{name}." if name else ""
        inner = StructType([StructField(f.name, walk(prefix + f.name, f.dataType), f.nullable) for f in dtype.fields])
        if name not in names:
            return inner
        found.add(name)
        value: DataType | None = None
        for f in inner.fields:
            value = f.dataType if value is None else _common(value, f.dataType)
        return MapType(StringType(), value or StringType())

    made = walk("", schema)
    if missing := sorted(set(names) - found):
        raise ValueError(f"no such object: {', '.join(missing)}")
    return made


def explode_maps_outer(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """A row for each entry of the named map columns (all, by default), as ``name.key`` and ``name.value``.

    An empty or null map keeps its row, with nulls; sibling maps give their cross product, as arrays do.
    """
    for name in map_columns(df) if names is None else names:
        others = [quoted(c) for c in df.columns if c != name]
        pair = f"explode_outer({quoted(name)}) AS ({quoted(f'{name}.key')}, {quoted(f'{name}.value')})"
        df = require_unique(df.selectExpr(*others, pair))
    return df


def map_keys(df: DataFrame, name: str, limit: int = MAX_KEYS) -> list[str]:
    """All keys of a map column, in order; more than ``limit`` raise ``ValueError``.

    One aggregate whose tasks send each key once; no more than ``limit`` + 1 keys are collected.
    """
    keys = df.select(F.explode(F.map_keys(flat(name))).alias("k")).distinct().limit(limit + 1).collect()
    if len(keys) > limit:
        raise ValueError(f"{name} has more than {limit} different keys: explode it instead")
    return sorted(r.k for r in keys)


def pivot_map(df: DataFrame, name: str, keys: Sequence[str] | None = None, limit: int = MAX_KEYS) -> DataFrame:
    """Replace a map column by a column ``name.key`` for each key; rows without the key have null.

    ``keys`` are given (a stable list of columns, other keys are left out) or asked of the data with :func:`map_keys`.
    """
    chosen = list(keys) if keys is not None else map_keys(df, name, limit)
    others = [flat(c) for c in df.columns if c != name]
    return require_unique(df.select(*others, *(F.try_element_at(flat(name), F.lit(k)).alias(f"{name}.{k}") for k in chosen)))
