"""Folds by id, and labelled texts for the models that are trained here: all of them, or samples bounded in rows.

Texts are whole: a model learns from all of each, as it scores all of each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from hitloom.llm.common import saved


def fold(key: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def labelled_texts(
    docs: DataFrame, labels: DataFrame, target: str, may_train: Column, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, label, text) for all labelled ids that ``may_train`` allows and that have a text.

    An id counts once for a label, with one text, however often either is
    repeated. Rows with a null id, label or text are left out.
    """
    known = labels.filter(F.col(target).isin(0, 1) & F.col(key).isNotNull() & may_train)
    # Saved, so that its size is known: while the ids can be broadcast, only texts with a label are shuffled.
    known = saved(known.select(F.col(key), F.col(target).cast("int").alias("label")).distinct(), "labelled")
    own = docs.filter(F.col(text).isNotNull() & F.col(key).isNotNull()).select(key, F.col(text).alias("_text"))
    own = own.join(known.select(key), key, "left_semi").groupBy(key).agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    return own.join(known, key).select(key, "label", F.col("_text").alias("text"))


def training_texts(
    docs: DataFrame,
    labels: DataFrame,
    target: str,
    may_train: Column,
    per_class: int,
    key: str = "doc_id",
    text: str = "text",
) -> list[tuple[str, int]]:
    """At most ``per_class`` texts of each label, chosen by a hash of the id: (text, 0 or 1).

    ``may_train`` is a condition on the key. Only ids that have a text are
    chosen, each once for a label, and one text is kept of each id before
    anything is collected, so the rows collected are bounded by ``per_class``
    however often an id is repeated. Rows with a null id, label or
    text are left out; of rows that repeat an id, one is taken.
    """
    known = labels.filter(F.col(target).isin(0, 1) & F.col(key).isNotNull() & may_train)
    known = known.select(F.col(key), F.col(target).cast("int").alias("_label")).distinct()
    there = docs.filter(F.col(text).isNotNull() & F.col(key).isNotNull()).select(key).distinct()
    known = saved(known.join(there, key, "left_semi"), "labelled")
    picked = None
    for value in (0, 1):
        part = known.filter(F.col("_label") == value).orderBy(F.xxhash64(key), key).limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    kept = [tuple(r) for r in picked.collect()]
    found = texts_of(docs, [(i,) for i, _ in kept], [key], text)
    return [(found[i,], value) for i, value in sorted(kept, key=lambda r: (r[1], str(r[0])))]


def texts_of(docs: DataFrame, picked: list[tuple], keys: list[str], text: str) -> dict[tuple, str]:
    """One whole text for each of these values of ``keys``; copies are merged before they are shuffled."""
    if not picked:
        return {}
    schema = StructType([StructField(k, docs.schema[k].dataType) for k in keys])
    wanted = docs.sparkSession.createDataFrame(sorted(set(picked), key=str), schema)
    own = docs.filter(F.col(text).isNotNull()).select(*keys, F.col(text).alias("_text"))
    found = own.join(F.broadcast(wanted), keys, "left_semi").groupBy(*keys).agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    return {tuple(r)[:-1]: r[-1] for r in found.collect()}
