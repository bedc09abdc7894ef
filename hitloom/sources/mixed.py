"""Hits whose fields hold a single value in some records and an array in others.

Schema inference widens such a field to text, and an array in text is never
exploded. Here records are read as variants first. One aggregate over all of
them finds their common structure and the fields that have none; a second finds
which of these hold an array anywhere, and the structure of all their values,
single ones and elements together. Such a field becomes an array everywhere: a
single value is an array of one. What still differs within the values is
looked at in the same way, level by level, until nothing is left; fields of
different types that are never arrays stay text, as inference makes them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)


class _Mixed(ArrayType):
    """An array whose records hold an array or a single value."""


def _parsed(text: str) -> DataType:
    """A type as the variant functions write it."""
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text)
    return _plain(DataType.fromDDL(ddl))


def _plain(dtype: DataType) -> DataType:
    """The types that JSON inference would give."""
    if isinstance(dtype, StructType):
        return StructType([StructField(f.name, _plain(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, ArrayType):
        return ArrayType(_plain(dtype.elementType))
    if isinstance(dtype, DecimalType) and dtype.scale:
        return DoubleType()
    return StringType() if isinstance(dtype, NullType) else dtype


def _read_as(dtype: DataType) -> DataType:
    """What a variant can be cast to: mixed fields stay variants."""
    if isinstance(dtype, _Mixed):
        return VariantType()
    if isinstance(dtype, StructType):
        return StructType([StructField(f.name, _read_as(f.dataType)) for f in dtype.fields])
    return ArrayType(_read_as(dtype.elementType)) if isinstance(dtype, ArrayType) else dtype


def _has_mixed(dtype: DataType) -> bool:
    if isinstance(dtype, StructType):
        return any(_has_mixed(f.dataType) for f in dtype.fields)
    return isinstance(dtype, _Mixed) or (isinstance(dtype, ArrayType) and _has_mixed(dtype.elementType))


def _as_array(value: Column) -> Column:
    """The elements of a variant that is an array, or the variant alone; null for nulls."""
    elements = F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array(value))
    return F.when(value.isNotNull() & ~F.is_variant_null(value), elements)


def _from_variant(value: Column, dtype: DataType) -> Column:
    return _resolved(value.cast(_read_as(dtype)), dtype)


def _resolved(value: Column, dtype: DataType) -> Column:
    """A value as read, its mixed fields made arrays."""
    if not _has_mixed(dtype):
        return value
    if isinstance(dtype, _Mixed):
        return F.transform(_as_array(value), lambda x: _from_variant(x, dtype.elementType))
    if isinstance(dtype, ArrayType):
        return F.transform(value, lambda x: _resolved(x, dtype.elementType))
    fields = (_resolved(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields)
    return F.when(value.isNotNull(), F.struct(*fields))


Path = tuple[str | None, ...]


def _open_leaves(dtype: DataType, path: Path = ()) -> Iterator[Path]:
    """Paths to variants; None is the step into an array."""
    if isinstance(dtype, VariantType):
        yield path
    elif isinstance(dtype, StructType):
        for f in dtype.fields:
            yield from _open_leaves(f.dataType, (*path, f.name))
    elif isinstance(dtype, ArrayType):
        yield from _open_leaves(dtype.elementType, (*path, None))


def _values(value: Column, path: Path) -> Column:
    """All values of a record at a path, as one array."""
    if not path:
        return F.array(value)
    if path[0] is not None:
        return _values(value.getField(path[0]), path[1:])
    return F.flatten(F.transform(F.coalesce(value, F.array()), lambda x: _values(x, path[1:])))


def _replaced(dtype: DataType, path: Path, leaf: DataType) -> DataType:
    if not path:
        return leaf
    if isinstance(dtype, ArrayType):
        return type(dtype)(_replaced(dtype.elementType, path[1:], leaf))
    return StructType(
        [StructField(f.name, _replaced(f.dataType, path[1:], leaf) if f.name == path[0] else f.dataType) for f in dtype.fields]
    )


def _settled(records: DataFrame, dtype: DataType, leaves: list[Path]) -> DataType:
    """The structure with each of these leaves made an array, where some record has one, or text."""
    hit = records.select(_from_variant(F.col("record"), dtype).alias("hit"))
    asked = []
    for k, path in enumerate(leaves):
        values = _values(F.col("hit"), path)
        is_array = F.exists(values, lambda x: F.schema_of_variant(x).startswith("ARRAY"))
        elements = F.flatten(F.transform(values, lambda x: F.coalesce(_as_array(x), F.array())))
        asked += [F.max(is_array).alias(f"is_array_{k}"), F.schema_of_variant_agg(F.to_variant_object(elements)).alias(f"kind_{k}")]
    found = hit.agg(*asked).first()
    for k, path in enumerate(leaves):
        element = getattr(_parsed(found[f"kind_{k}"]), "elementType", StringType())
        if isinstance(element, VariantType):
            element = StringType()
        dtype = _replaced(dtype, path, _Mixed(element) if found[f"is_array_{k}"] else StringType())
    return dtype


def with_mixed_arrays(lines: DataFrame, fixed: dict[str, DataType]) -> DataFrame:
    """Columns of JSON objects (``value``, one per row); fields that are arrays in some records are arrays in all.

    ``fixed`` are types of top-level fields that are not asked of the data. Text
    that is no JSON object, or names a field twice in an object, fails the query.
    Numbers among texts are written plainly (1.50 as 1.5). No lines: no columns.
    """
    records = lines.select(F.parse_json("value").alias("record"))
    text = records.agg(F.schema_of_variant_agg("record")).first()[0]
    dtype = StructType() if text in (None, "VOID") else _parsed(text)
    if not isinstance(dtype, StructType):
        raise ValueError("not all lines are JSON objects")
    dtype = StructType([StructField(f.name, fixed.get(f.name, f.dataType)) for f in dtype.fields])
    while leaves := list(_open_leaves(dtype)):
        dtype = _settled(records, dtype, leaves)
    return records.select(_from_variant(F.col("record"), dtype).alias("hit")).select("hit.*")
