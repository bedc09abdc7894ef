"""Silver and gold tables and where they live."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, DecimalType, MapType, StructType


def layer_path(root: str, topic: str, layer: str) -> str:
    """``root/topic/layer``: one directory per topic and layer."""
    return f"{root.rstrip('/')}/{topic}/{layer}"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Read a layer. ``fmt`` is any format of the session, such as "delta"."""
    return spark.read.format(fmt).options(**options).load(path)


class SchemaChange(ValueError):
    """A table would be replaced by one whose schema its readers do not expect."""


#: What a stored type may be widened to without losing a value.
_WIDER = {
    "byte": ("short", "integer", "long", "float", "double"),
    "short": ("integer", "long", "float", "double"),
    "integer": ("long", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


def _changes(name: str, old: DataType, new: DataType, by_case: bool) -> Iterator[tuple[str, bool]]:
    """(what differs, whether it only widens); null or not is no difference."""
    if isinstance(old, StructType) and isinstance(new, StructType):
        fold = str if by_case else str.lower
        before, after = ({fold(f.name): f for f in t.fields} for t in (old, new))
        prefix = f"{name}." if name else ""
        for key, f in before.items():
            if key in after:
                yield from _changes(prefix + f.name, f.dataType, after[key].dataType, by_case)
            else:
                yield f"{prefix}{f.name} is gone", False
        for key, f in after.items():
            if key not in before:
                yield f"{prefix}{f.name} is new", True
    elif isinstance(old, ArrayType) and isinstance(new, ArrayType):
        yield from _changes(f"{name}[]", old.elementType, new.elementType, by_case)
    elif isinstance(old, MapType) and isinstance(new, MapType):
        yield from _changes(f"{name}.key", old.keyType, new.keyType, by_case)
        yield from _changes(f"{name}.value", old.valueType, new.valueType, by_case)
    elif old != new:
        wider = new.typeName() in _WIDER.get(old.typeName(), ())
        if isinstance(old, DecimalType) and isinstance(new, DecimalType):
            wider = new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
        yield f"{name} was {old.simpleString()}, is {new.simpleString()}", wider


def schema_changes(old: StructType, new: StructType, by_case: bool = False) -> tuple[list[str], list[str]]:
    """What a new schema widens (new fields, wider types), and what it breaks (lost fields, other types)."""
    found = list(_changes("", old, new, by_case))
    return [text for text, widens in found if widens], [text for text, widens in found if not widens]


def stored_schema(spark: SparkSession, path: str, fmt: str = "parquet") -> StructType | None:
    """The schema of the table at ``path``; None if there is none yet."""
    try:
        return read_table(spark, path, fmt).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_table(df: DataFrame, path: str, fmt: str = "parquet", schema_change: str = "refuse", **options: str) -> None:
    """Replace a layer. Rows are written by the tasks that made them.

    A layer that is there already is only replaced by one with the same fields and types, in any order,
    null or not; before it is touched, `SchemaChange` says what is different. ``schema_change="widen"``
    lets new fields and wider types pass, ``"any"`` everything.

    Exploded rows can make a task's file large: ``maxRecordsPerFile`` bounds it.
    """
    if schema_change not in ("refuse", "widen", "any"):
        raise ValueError(f"schema_change {schema_change!r}: expected 'refuse', 'widen' or 'any'")
    if schema_change != "any" and (old := stored_schema(df.sparkSession, path, fmt)) is not None:
        by_case = df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
        widened, broken = schema_changes(old, df.schema, by_case)
        if different := broken + (widened if schema_change == "refuse" else []):
            raise SchemaChange(f"{path}: {'; '.join(different)}")
    df.write.format(fmt).mode("overwrite").options(**options).save(path)
