"""What the operators share: word arrays, named values in SQL expressions, tables between steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.workload.records import scratch_dir, table

__all__ = ["BROADCAST_ROWS", "fold_ascii", "let", "saved", "scratch_dir", "shingles", "small_side", "table", "whole_text", "words"]

#: Bytes that part words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"

#: Rows of a few longs or short strings that may be broadcast (a few MB); a larger side is shuffled.
BROADCAST_ROWS = 100_000


def whole_text(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text: runs of anything but ASCII white space."""
    return F.array_remove(F.split(text, WORD_GAP), "")


def fold_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles(items: Column, width: int, of: Callable[..., Column]) -> Column:
    """``of(w1, ..., w_width)`` for each run of ``width`` words; for fewer words, of all of them.

    ``of`` must take any number of columns. No words: an empty array. ``items``
    must be a column of its own (not an expression), as each shingle reads it.
    """
    n = F.size(items)
    whole = [
        (k, F.array(of(*(F.get(items, F.lit(i)) for i in range(k)))))
        for k in range(1, width)
    ]
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))),
        lambda i: of(*(F.get(items, i + k if k else i) for k in range(width))),
    )
    short = F.slice(runs, 1, 0)
    for k, value in whole:
        short = F.when(n == k, value).otherwise(short)
    return F.when(n >= width, runs).otherwise(short)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later steps neither recompute it nor depend on executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint at a broadcast if the frame has been counted to have few rows; else leave the join to a shuffle.

    ``df`` should be cheap to count (a written table).
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
