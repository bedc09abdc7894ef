"""Aggregates of unpacked rows without making the rows.

Sibling arrays of a record multiply: with m and n elements they unpack into
m * n rows, each element repeated n or m times. Counts, sums and averages over
those rows are sums over each array alone, times the number of rows that its
siblings come to; least and greatest values do not change at all. So every
record is reduced where it lies, by a projection made from the schema, and
groups are added up from one row per record.

Only arrays that a group key lies in are exploded.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, DoubleType, FloatType, LongType, StructType

from hitloom.operators.columns import flat
from hitloom.operators.nested import array_columns, explode_outer_all, flatten

FUNCTIONS = ("count", "sum", "avg", "min", "max")


def _product(factors: list[Column | None]) -> Column | None:
    known = [f for f in factors if f is not None]
    return reduce(mul, known) if known else None


def _times(value: Column, factor: Column | None) -> Column:
    return value if factor is None else value * factor


def _multiplies(dtype: DataType) -> bool:
    if isinstance(dtype, StructType):
        return any(_multiplies(f.dataType) for f in dtype.fields)
    return isinstance(dtype, ArrayType)


def _rows(value: Column, dtype: DataType) -> Column | None:
    """How many rows a value unpacks into; None where that is always one."""
    if isinstance(dtype, StructType):
        return _product([_rows(value.getField(f.name), f.dataType) for f in dtype.fields])
    if not isinstance(dtype, ArrayType):
        return None
    if not _multiplies(dtype.elementType):
        return F.greatest(F.size(value), F.lit(1)).cast("long")
    total = F.aggregate(value, F.lit(0).cast("long"), lambda sum_, x: sum_ + _rows(x, dtype.elementType))
    return F.when(F.size(value) > 0, total).otherwise(F.lit(1).cast("long"))


def _field(dtype: StructType, path: str) -> str:
    """The field that a flat name goes on with; names may hold dots themselves."""
    found = [f.name for f in dtype.fields if path == f.name or path.startswith(f"{f.name}.")]
    if not found:
        raise ValueError(f"no such field: {path}")
    return max(found, key=len)


def _leaf_type(dtype: DataType, path: str) -> DataType:
    if isinstance(dtype, ArrayType):
        return _leaf_type(dtype.elementType, path)
    if isinstance(dtype, StructType):
        name = _field(dtype, path)
        return _leaf_type(dtype[name].dataType, path[len(name) + 1 :])
    if path:
        raise ValueError(f"no such field: {path}")
    return dtype


def _total(value: Column, dtype: DataType, path: str, zero: Column, of: Callable[[Column], Column]) -> Column:
    """The sum of ``of(leaf)`` over the rows that a value unpacks into."""
    if isinstance(dtype, ArrayType):
        return F.coalesce(F.aggregate(value, zero, lambda sum_, x: sum_ + _total(x, dtype.elementType, path, zero, of)), zero)
    if isinstance(dtype, StructType):
        name = _field(dtype, path)
        others = _product([_rows(value.getField(f.name), f.dataType) for f in dtype.fields if f.name != name])
        return _times(_total(value.getField(name), dtype[name].dataType, path[len(name) + 1 :], zero, of), others)
    return F.coalesce(of(value), zero)


def _extreme(value: Column, dtype: DataType, path: str, of_array: Callable[[Column], Column]) -> Column:
    if isinstance(dtype, ArrayType):
        return of_array(F.transform(value, lambda x: _extreme(x, dtype.elementType, path, of_array)))
    if isinstance(dtype, StructType):
        name = _field(dtype, path)
        return _extreme(value.getField(name), dtype[name].dataType, path[len(name) + 1 :], of_array)
    return value


def _sum_type(dtype: DataType) -> DataType:
    if isinstance(dtype, DecimalType):
        return DecimalType(38, dtype.scale)
    return DoubleType() if isinstance(dtype, (DoubleType, FloatType)) else LongType()


def _root(df: DataFrame, name: str) -> str:
    found = [c for c in df.columns if name == c or name.startswith(f"{c}.")]
    if not found:
        raise ValueError(f"no such column: {name}")
    return max(found, key=len)


def aggregate_unpacked(
    df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, tuple[str, str | None]], names: Mapping[str, str] | None = None
) -> DataFrame:
    """What ``unpack(df)``, grouped by ``keys``, aggregates to.

    Keys and columns are flat names, as :func:`~hitloom.operators.nested.unpack`
    gives them. ``aggregates`` maps a new name to a function (count, sum, avg, min
    or max) and its column; ``("count", None)`` counts rows. ``names`` renames keys.
    Sums are of the type that Spark's own sums have; those of doubles may differ
    in the last digits, as they are added in another order. No keys: one row.
    """
    if unknown := sorted({fn for fn, _ in aggregates.values()} - set(FUNCTIONS)):
        raise ValueError(f"no such function: {', '.join(unknown)}")
    if any(column is None and fn != "count" for fn, column in aggregates.values()):
        raise ValueError("only count goes without a column")
    df = flatten(df)
    while arrays := [c for c in array_columns(df) if any(_root(df, k) == c for k in keys)]:
        df = flatten(explode_outer_all(df, arrays))
    types = {f.name: f.dataType for f in df.schema.fields}
    rows = {c: f"__rows_{k}" for k, c in enumerate(array_columns(df))}
    counted = df.withColumns({alias: _rows(flat(c), types[c]) for c, alias in rows.items()})
    one = F.lit(1).cast("long")

    partial: dict[str, Column] = {}
    finals: list[Column] = []
    for k, (name, (fn, column)) in enumerate(aggregates.items()):
        if column is None:
            partial[f"__n_{k}"] = _product([F.col(a) for a in rows.values()]) if rows else one
            finals.append(F.coalesce(F.sum(f"__n_{k}"), F.lit(0)).cast("long").alias(name))
            continue
        root = _root(df, column)
        dtype, path = types[root], column[len(root) + 1 :]
        leaf = _leaf_type(dtype, path)
        if fn in ("min", "max"):
            partial[f"__v_{k}"] = _extreme(flat(root), dtype, path, F.array_min if fn == "min" else F.array_max)
            finals.append((F.min if fn == "min" else F.max)(f"__v_{k}").alias(name))
            continue
        weight = _product([F.col(a) for c, a in rows.items() if c != root])
        zero = F.lit(0).cast("long")
        present = _total(flat(root), dtype, path, zero, lambda x: x.isNotNull().cast("long"))
        partial[f"__n_{k}"] = _times(present, weight)
        n = F.coalesce(F.sum(f"__n_{k}"), F.lit(0)).cast("long")
        if fn == "count":
            finals.append(n.alias(name))
            continue
        kind = _sum_type(leaf)
        total = _total(flat(root), dtype, path, F.lit(0).cast(kind), lambda x, kind=kind: x.cast(kind))
        partial[f"__v_{k}"] = _times(total, weight).cast(kind)
        whole = F.when(n > 0, F.sum(f"__v_{k}").cast(kind))
        finals.append((whole if fn == "sum" else whole.cast("double") / n).alias(name))
    chosen = [flat(c).alias((names or {}).get(c, c)) for c in keys]
    reduced = counted.select(*chosen, *(e.alias(a) for a, e in partial.items()))
    return reduced.groupBy(*(flat((names or {}).get(c, c)) for c in keys)).agg(*finals)
