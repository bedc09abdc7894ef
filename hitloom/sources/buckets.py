"""Tables that are stored as lookups and lookups' left sides want them: by the hash of a key, sorted.

A join of two tables with equally many buckets of the join key reads them as
they lie: nothing is shuffled, however often the join runs. Where only the
lookup is bucketed, only the other side is shuffled.

The buckets are part of the session's catalog, not of the files, so a table has
a name; another session registers the folder again with `read_bucketed`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.operators.columns import flat, quoted, require_unique
from hitloom.sources.tables import read_table

_KEY = "__bucket_key"


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, fmt: str = "parquet", **options: str) -> DataFrame:
    """Replace the table ``name`` at ``path`` by ``df``, a file for each of ``buckets`` buckets of ``key``, sorted by it.

    Rows are shuffled once, here. Buckets should be so many that one fits a task: the rows of a key are
    all in one (see :func:`bucketed_left_join` for keys with very many).
    """
    dealt = df.repartition(buckets, flat(key))
    writer = dealt.write.format(fmt).mode("overwrite").options(**options).bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, name: str, path: str, key: str, buckets: int, fmt: str = "parquet") -> DataFrame:
    """The table that :func:`write_bucketed` has left at ``path``, registered as ``name`` if this session does not know it."""
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in read_table(spark, path, fmt).schema.fields)
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({fields}) USING {fmt} CLUSTERED BY ({quoted(key)}) SORTED BY ({quoted(key)}) "
            f"INTO {buckets} BUCKETS LOCATION '{location}'"
        )
    return spark.table(name)


def bucketed_left_join(
    df: DataFrame, lookup: DataFrame, left_key: str, right_key: str, take: Mapping[str, str], hot_keys: Sequence = ()
) -> DataFrame:
    """Add columns of ``lookup`` to ``df`` where ``left_key = right_key``, by their buckets.

    The rows are those of :func:`~hitloom.operators.lookup.lookup_left_join`. Rows with a null key match
    nothing and are not joined; rows with one of the ``hot_keys`` (keys with a large share of the rows) are
    joined apart, by a shuffle that adaptive execution splits or a broadcast, so neither fills the task of a bucket.
    """
    items = ((right_key, _KEY), *take.items())
    right = lookup.selectExpr(*(f"{quoted(name)} AS {quoted(alias)}" for name, alias in items))
    require_unique(df.select("*", *(F.lit(None).alias(alias) for alias in take.values())))

    def joined(rows: DataFrame, of: DataFrame) -> DataFrame:
        return rows.join(of, flat(left_key) == flat(_KEY), "left").drop(_KEY)

    key = flat(left_key)
    hot = key.isin(list(hot_keys)) if hot_keys else F.lit(False)
    parts = [joined(df.filter(key.isNotNull() & ~hot), right)]
    if hot_keys:
        parts.append(joined(df.filter(hot), right.filter(flat(_KEY).isin(list(hot_keys)))))
    nothing = (F.lit(None).cast(lookup.schema[name].dataType).alias(alias) for name, alias in take.items())
    made = parts[0]
    for part in [*parts[1:], df.filter(key.isNull()).select("*", *nothing)]:
        made = made.unionByName(part)
    return made
