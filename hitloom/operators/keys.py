"""Auditing keys that are made by joining values without a separator: "1" + "23" and "12" + "3" are one key.

`key_sketches` counts the different keys and the different tuples of parts in
buckets of keys by HyperLogLog sketches. They are small, form in the tasks that
read a layer, and merge over layers and runs. A bucket whose tuples outnumber
its keys holds a collision; only there does `key_collisions` look at the rows.
Buckets hold few keys, where a sketch keeps them all and counts them rightly but
for the chance of two hashes of 26 bits being equal (1 in 10,000 or so for a
bucket); without sketches `key_collisions` looks at every key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.operators.columns import flat

#: Keys of a bucket, about.
BUCKET_KEYS = 64


def _tuple(parts: Sequence[str]) -> Column:
    """The parts as one text from which they can be told apart again; null parts are told from empty ones."""
    each = (F.coalesce(F.concat(F.length(flat(p).cast("string")), F.lit(":"), flat(p).cast("string")), F.lit("-")) for p in parts)
    return F.concat(*each)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(flat(key)), F.lit(buckets))


def key_sketches(df: DataFrame, key: str, parts: Sequence[str], buckets: int | None = None) -> DataFrame:
    """(bucket, keys, tuples): sketches of the different keys and tuples of parts of each bucket of keys.

    Tables that are to be merged need the same number of ``buckets``; by default there is one for
    `BUCKET_KEYS` rows. Rows without a key are left out.
    """
    known = df.filter(flat(key).isNotNull())
    if buckets is None:
        buckets = max(1, -(-known.count() // BUCKET_KEYS))
    return known.groupBy(_bucket(key, buckets).alias("bucket"), F.lit(buckets).cast("long").alias("of")).agg(
        F.hll_sketch_agg(flat(key).cast("string"), F.lit(12)).alias("keys"), F.hll_sketch_agg(_tuple(parts), F.lit(12)).alias("tuples")
    )


def merged_sketches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The sketches of several layers or runs as those of all their rows."""
    for other in others:
        first = first.unionByName(other)
    return first.groupBy("bucket", "of").agg(F.hll_union_agg("keys").alias("keys"), F.hll_union_agg("tuples").alias("tuples"))


def sketched_counts(sketches: DataFrame) -> DataFrame:
    """(n_keys, n_tuples, n_suspicious): estimates of the different keys and tuples, and the buckets where they differ."""
    differ = F.hll_sketch_estimate("tuples") > F.hll_sketch_estimate("keys")
    return sketches.agg(
        F.sum(F.hll_sketch_estimate("keys")).alias("n_keys"),
        F.sum(F.hll_sketch_estimate("tuples")).alias("n_tuples"),
        F.count_if(differ).alias("n_suspicious"),
    )


def key_collisions(df: DataFrame, key: str, parts: Sequence[str], sketches: DataFrame | None = None) -> DataFrame:
    """(key, parts...) once for every different tuple of parts of a key that has more than one.

    With ``sketches`` (of these rows, or of more) only rows in buckets whose sketches disagree are looked at.
    A key's tuples are reduced to the least and the greatest in each task, so a key of any number of rows is cheap.
    """
    known = df.filter(flat(key).isNotNull()).select(flat(key), *(flat(p) for p in parts))
    if sketches is not None:
        differ = sketches.filter(F.hll_sketch_estimate("tuples") > F.hll_sketch_estimate("keys")).select("bucket", "of")
        of = sketches.select("of").first()
        if of is None:
            return known.limit(0)
        known = known.withColumn("__bucket", _bucket(key, of["of"]))
        known = known.join(differ.select(F.col("bucket").alias("__bucket")), "__bucket", "left_semi").drop("__bucket")
    ends = known.groupBy(flat(key).alias("__key")).agg(F.min(_tuple(parts)).alias("low"), F.max(_tuple(parts)).alias("high"))
    collided = ends.filter("low <> high").select("__key")
    return known.distinct().join(collided, flat(key) == F.col("__key"), "left_semi")
