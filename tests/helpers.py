from collections import Counter
from itertools import product

from pyspark.sql.types import ArrayType, StructType

SF_SMALL = "/root/testdata/sf0.001"


def bag(df) -> Counter:
    return Counter(tuple(row) for row in df.collect())


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def brute_unpack(value, dtype, name=""):
    """Rows of one value, by recursion: the definition to test against."""
    if isinstance(dtype, StructType):
        children = [
            brute_unpack(
                None if value is None else value[field.name],
                field.dataType,
                f"{name}.{field.name}" if name else field.name,
            )
            for field in dtype.fields
        ]
        return [{k: v for part in parts for k, v in part.items()} for parts in product(*children)]
    if isinstance(dtype, ArrayType):
        elements = value if value else [None]
        return [row for element in elements for row in brute_unpack(element, dtype.elementType, name)]
    return [{name: value}]


def brute_bag(records, schema, columns) -> Counter:
    rows = [row for record in records for row in brute_unpack(record, schema)]
    return Counter(tuple(row[c] for c in columns) for row in rows)
