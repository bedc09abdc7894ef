"""Benchmark decontamination: which documents contain which test items.

Containment search over size partitions. An item of ``n`` distinct shingles is
contained in a document if the document has at least ``share`` per cent of
them. Items are partitioned by size (powers of two); all items of a partition
get a MinHash sketch of their ``k`` smallest shingle hashes, where ``k`` is one
more than the largest item of the partition may miss. A document that contains
an item misses at most ``n * (100 - share) / 100`` of its shingles and so shares
at least one sketch value, often several: candidates are the documents that
share as many values as the bound says. However long the document is, no
contained item is lost. Candidates are then verified on the shingles themselves.

Everything is DataFrame functions. Documents are read twice, and only hashes
that meet a sketch are ever shuffled; the text of candidates alone is looked at again.

Words are runs of letters, marks and digits in lower case, so case and
punctuation do not hide a passage. Defined cases: null or empty texts hold
nothing; items (and documents) of one to four words are one shingle of all
their words; items without words match nothing; rows without an id cannot be
named and are left out; rows that share an id count as one text's shingles;
other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import saved, shingles, small_side, whole_text

SHINGLE_WORDS = 5
SHARE = 80

_GAP = r"[^\p{L}\p{M}\p{N}]+"


def plain_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _GAP), "")


def _named(df: DataFrame, key: str, text: str, name: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).select(F.col(key).alias(name), plain_words(whole_text(text)).alias("w"))


def _hashes(w: Column) -> Column:
    return F.array_distinct(shingles(w, SHINGLE_WORDS, F.xxhash64))


def _texts(w: Column) -> Column:
    return F.array_distinct(shingles(w, SHINGLE_WORDS, lambda *x: F.concat_ws(" ", *x)))


def sketches(items: DataFrame, share: int = SHARE) -> DataFrame:
    """(item, h, needed): each item's sketch values and how many of them a document must share.

    ``items`` is (item, w). The sketch of a partition is as long as its largest size needs.
    """
    may_miss = lambda n: F.floor(n * (100 - share) / 100)
    sized = (
        items.select("item", F.explode(_hashes(F.col("w"))).alias("h"))
        .groupBy("item")
        .agg(F.sort_array(F.collect_set("h")).alias("hs"))
        .withColumn("n", F.size("hs"))
        .withColumn("largest", F.expr("2 * shiftleft(1, cast(floor(log2(n)) as int)) - 1"))
        .withColumn("k", F.least("n", may_miss(F.col("largest")) + 1).cast("int"))
    )
    return sized.select(
        "item", F.explode(F.slice("hs", F.lit(1), F.col("k"))).alias("h"), (F.col("k") - may_miss(F.col("n"))).alias("needed")
    )


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
    item_text: str = "text",
    share: int = SHARE,
) -> DataFrame:
    """(key, item_key, n_shared, n_item, containment) for each contained item of each document."""
    tests = _named(items, item_key, item_text, "item")
    wanted = small_side(saved(sketches(tests, share), "sketches"))
    candidates = saved(
        _named(docs, key, text, "id")
        .select("id", F.explode(_hashes(F.col("w"))).alias("h"))
        .join(wanted, "h")
        .groupBy("id", "item", "needed")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= F.col("needed"))
        .select("id", "item"),
        "candidates",
    )
    passages = saved(tests.select("item", F.explode(_texts(F.col("w"))).alias("s")).distinct(), "passages")
    sizes = passages.groupBy("item").agg(F.count("*").alias("n_item"))
    again = docs.join(
        small_side(candidates.select(F.col("id").alias(key)).distinct()), key, "left_semi"
    )
    shared = (
        _named(again, key, text, "id")
        .select("id", F.explode(_texts(F.col("w"))).alias("s"))
        .join(small_side(passages), "s")
        .select("id", "item", "s")
        .distinct()
        .groupBy("id", "item")
        .agg(F.count("*").alias("n_shared"))
    )
    return (
        shared.join(small_side(sizes), "item")
        .filter(F.col("n_shared") * 100 >= F.col("n_item") * share)
        .select(
            F.col("id").alias(key),
            F.col("item").alias(item_key),
            "n_shared",
            "n_item",
            (F.col("n_shared") / F.col("n_item")).alias("containment"),
        )
    )
