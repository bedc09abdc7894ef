"""Turn nested columns into flat rows.

Everything here builds a plan from ``df.schema`` alone: no row is looked at,
nothing is collected and nothing is shuffled. A pass costs one projection plus
one generator per array column, so the whole of :func:`unpack` runs inside the
scan's own tasks whatever the size of the input. Projections are written as SQL
items, since a wide schema makes thousands of ``Column`` calls slow.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, StructType

from hitloom.operators.columns import drop_columns, quoted, require_unique
from hitloom.operators.maps import explode_maps_outer, map_columns


def _leaves(name: str, path: str, dtype: DataType) -> list[str]:
    """Select items for what a field turns into: itself, or its fields at every depth."""
    if not isinstance(dtype, StructType):
        return [f"{path} AS {quoted(name)}"]
    return [
        item
        for field in dtype.fields
        for item in _leaves(f"{name}.{field.name}", f"{path}.{quoted(field.name)}", field.dataType)
    ]


def flatten(df: DataFrame) -> DataFrame:
    """Replace every struct column by its fields, named ``parent.child``.

    Plain columns come first and keep their order; struct fields follow. Two
    fields that end up under one name raise ``ValueError``.
    """
    fields = df.schema.fields
    if not any(isinstance(f.dataType, StructType) for f in fields):
        return df
    plain_first = sorted(fields, key=lambda f: isinstance(f.dataType, StructType))
    items = [item for f in plain_first for item in _leaves(f.name, quoted(f.name), f.dataType)]
    return require_unique(df.selectExpr(*items))


def array_columns(df: DataFrame) -> list[str]:
    """Names of the columns that hold arrays."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]


def explode_outer_all(df: DataFrame, names: Collection[str], spread: int | None = None) -> DataFrame:
    """Explode the named arrays one after another.

    Sibling arrays give their cross product; an empty or null array keeps its
    row with a null. Names are compared as the session does (by default without
    regard to case). Columns that are not arrays stay as they are; a name that
    is no column raises ``ValueError``.

    With ``spread``, rows are dealt out over that many tasks before every
    explode but the first, so that the product of one record's siblings is
    made by many tasks.
    """
    fold = str if df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true" else str.lower
    columns = {fold(c): c for c in df.columns}
    if unknown := [name for name in names if fold(name) not in columns]:
        raise ValueError(f"no such column: {', '.join(unknown)}")
    present = set(array_columns(df))
    arrays = [c for c in dict.fromkeys(columns[fold(name)] for name in names) if c in present]
    for position, name in enumerate(arrays):
        if spread and position:
            df = df.repartition(spread)
        df = df.selectExpr(
            *(
                f"explode_outer({quoted(c)}) AS {quoted(c)}" if c == name else quoted(c)
                for c in df.columns
            )
        )
    return df


def unpack(
    df: DataFrame,
    drop_first: Iterable[str] = (),
    before_explode: Callable[[DataFrame], DataFrame] | None = None,
    spread: int | None = None,
    maps: bool = False,
) -> DataFrame:
    """Flatten and explode until neither structs nor arrays are left.

    The number of passes is bounded by the nesting depth of the schema.

    ``drop_first`` names flat columns to drop as soon as they show up, before
    they can multiply rows. Without it every array counts, also one that a
    later step drops.

    ``before_explode`` is applied to the flattened records while there is still
    one row per record; work that needs record-level columns only (a lookup, a
    hash) is done once per record there instead of once per exploded row.

    ``spread`` is for records that explode into a large share of all rows: it
    redistributes rows between explodes, at the price of a shuffle each. Leave
    it out where arrays are of ordinary size, and nothing is shuffled at all.
    """
    drop_first = tuple(drop_first)
    df = drop_columns(flatten(df), *drop_first)
    if before_explode is not None:
        df = before_explode(df)
    first_pass = True
    while (arrays := array_columns(df)) or (maps and map_columns(df)):
        if spread and not first_pass:
            df = df.repartition(spread)
        df = explode_outer_all(df, arrays, spread)
        df = drop_columns(flatten(explode_maps_outer(df) if maps else df), *drop_first)
        first_pass = False
    return df
