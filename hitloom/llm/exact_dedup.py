"""Exact duplicates by composable polynomial fingerprints, confirmed chunk by chunk.

A text is read as a polynomial: its UTF-8 bytes, two at a time, are the digits
of a number in base ``BASE``, taken modulo a prime. Chunks of `CHUNK` bytes are
hashed on their own, and the fingerprint of the whole is the sum of the chunks'
hashes, each shifted by the length of what follows it:
``H(AB) = H(A) * BASE**digits(B) + H(B)``. A sum needs no order, so chunks of a
text of more than `SPREAD` bytes are dealt over tasks, hashed side by side and
added up by an ordinary aggregate; shorter texts are hashed where they lie.

Texts of equal fingerprint and length are candidates only. They are compared as
streams of chunks: for each chunk number, the smallest and the largest chunk of
the group must be the same bytes. Both are running aggregates that tasks form
before anything is shuffled, so a group of copies of any size sends two chunks
per task, and no pair is ever made. A group that fails is split by the contents
of its chunks, exactly.

Defined cases: null text is the empty text, all empty texts are equal; rows with
a null id take part, and stay only where no equal text has an id; of rows that
share text and the largest id, one stays; repeated rows are rows of their own;
an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import saved, whole_text

#: Bytes of a chunk, an even number: digit sums of one chunk stay below 2**64.
CHUNK = 1 << 16

#: Texts of more bytes have their chunks dealt over tasks.
SPREAD = 1 << 22

#: A Mersenne prime, and any number below it as the base.
MODULUS = (1 << 61) - 1
BASE = 1_734_205_768_423_905_817

#: A group of this share of all rows or more is hot; there are at most so many.
HOT_SHARE = 1_000

#: Bits of the filter for candidates: 16 MB at most, whatever the number of groups.
FILTER_BITS = 1 << 27

_LOW = (1 << 32) - 1


@lru_cache(maxsize=4)
def _powers(modulus: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, the highest first, as halves of 32 bits; ``[-n:]`` weighs a chunk of n digits."""
    power, powers = 1, []
    for _ in range(CHUNK // 2):
        powers.append(power)
        power = power * base % modulus
    whole = np.array(powers[::-1], dtype=np.uint64)
    return whole & np.uint64(_LOW), whole >> np.uint64(32)


def digits(n_bytes: int) -> int:
    return (n_bytes + 1) // 2


def chunk_hash(data: memoryview | bytes, modulus: int = MODULUS, base: int = BASE) -> int:
    """The polynomial of one chunk; an odd last byte is a digit of its own."""
    n = len(data)
    word = np.empty(digits(n), dtype=np.uint64)
    word[: n // 2] = np.frombuffer(data, dtype="<u2", count=n // 2)
    if n % 2:
        word[-1] = np.frombuffer(data, dtype="u1")[-1]
    low, high = _powers(modulus, base)
    if not len(word):
        return 0
    return (int(word @ low[-len(word) :]) + (int(word @ high[-len(word) :]) << 32)) % modulus


def shifted(value: int, n_digits: int, modulus: int = MODULUS, base: int = BASE) -> int:
    """A chunk's share of the whole: its hash with so many digits after it."""
    return value * pow(base, n_digits, modulus) % modulus


def fingerprint(data: bytes, modulus: int = MODULUS, base: int = BASE) -> int:
    view, total = memoryview(data), 0
    for low in range(0, len(view), CHUNK):
        part = view[low : low + CHUNK]
        total += shifted(chunk_hash(part, modulus, base), digits(len(view) - low - len(part)), modulus, base)
    return total % modulus


def _with_fingerprint(rows: DataFrame, modulus: int, base: int, keep: bool) -> DataFrame:
    """Rows with a last column ``bytes``, and its fingerprint as ``fp``; the bytes themselves only with ``keep``."""
    kept = rows if keep else rows.drop("bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_buffer(), modulus, base) for x in batch.column("bytes")]
            names = [name for name in batch.schema.names if keep or name != "bytes"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, pa.int64())], names=[*names, "fp"])

    return rows.mapInArrow(run, ", ".join([f"`{name}` {kind}" for name, kind in kept.dtypes] + ["fp long"]))


def _chunked(rows: DataFrame) -> DataFrame:
    """A row for each chunk ``k`` of ``bytes``; empty texts have none."""
    last = F.floor((F.col("n") - 1) / F.lit(CHUNK)).cast("int")
    numbers = F.when(F.col("n") > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    # Cut before the explode, which would copy the whole text for each of its chunks.
    cut = F.transform(numbers, lambda k: F.struct(k.alias("k"), F.substring(F.col("bytes"), k * CHUNK + 1, F.lit(CHUNK)).alias("bytes")))
    others = [c for c in rows.columns if c != "bytes"]
    return rows.select(*others, F.explode(cut).alias("chunk")).select(*others, "chunk.k", "chunk.bytes")


def _summed(chunks: DataFrame, modulus: int, base: int) -> DataFrame:
    """(row, fp): chunks hashed where they have been dealt to, shifted and added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lengths, numbers = (batch.column(c).to_pylist() for c in ("row", "n", "k"))
            share = []
            for n, k, x in zip(lengths, numbers, batch.column("bytes")):
                data = x.as_buffer()
                share.append(shifted(chunk_hash(data, modulus, base), digits(n - k * CHUNK - len(data)), modulus, base))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(share, pa.int64())], names=["row", "share"])

    total = F.sum(F.col("share").cast("decimal(38,0)"))
    shares = chunks.select("row", "n", "k", "bytes").mapInArrow(run, "row long, share long")
    return shares.groupBy("row").agg(F.pmod(total, F.lit(modulus).cast("decimal(38,0)")).cast("long").alias("fp"))


def _fingerprinted(numbered: DataFrame, modulus: int, base: int, spread: int, keep: bool) -> DataFrame:
    """Rows with ``fp``, texts of any length; with ``keep``, the text as ``bytes``."""
    rows = numbered.withColumn("bytes", F.col("text").cast("binary")).drop("text")
    near = _with_fingerprint(rows.filter(F.col("n") <= spread), modulus, base, keep)
    far = rows.filter(F.col("n") > spread)
    summed = _summed(_chunked(far).repartition("row", "k"), modulus, base)
    return near.unionByName(far.join(summed, "row").select(*near.columns))


def _candidates(rows: DataFrame, multiple: DataFrame) -> DataFrame:
    """Rows that may be of a group in ``multiple``: their hash is in a bitmap of all groups. Loses none."""
    place = F.pmod(F.xxhash64("fp", "n"), F.lit(FILTER_BITS))
    bitmaps = multiple.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")
    )
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bitmap", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.expr(f"shiftleft(1, cast(bitmap_bit_position(pmod(xxhash64(fp, n), {FILTER_BITS}L)) % 8 as int))")) != 0
    marked = rows.withColumn("bucket", F.bitmap_bucket_number(place)).join(F.broadcast(bitmaps), "bucket")
    return marked.filter(is_set).drop("bucket", "bitmap")


def _differing(rows: DataFrame, multiple: DataFrame) -> DataFrame:
    """(fp, n) of groups whose texts are not all the same, found by comparing chunk with chunk."""
    chunks = _chunked(_candidates(rows, multiple))
    ends = chunks.groupBy("fp", "n", "k").agg(F.min("bytes").alias("low"), F.max("bytes").alias("high"))
    return ends.filter("low <> high").select("fp", "n").distinct()


def _split(rows: DataFrame, differing: DataFrame) -> DataFrame:
    """(row, class) for rows of groups that differ: for each chunk, the smallest row with the same bytes there."""
    chunks = _chunked(rows.join(differing, ["fp", "n"], "left_semi"))
    first = chunks.groupBy("fp", "n", "k", "bytes").agg(F.min("row").alias("first"))
    same = chunks.select("fp", "n", "k", "bytes", "row").join(first, ["fp", "n", "k", "bytes"])
    return same.groupBy("row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "first"))), lambda x: x["first"]).alias("class")
    )


def _order(key: str) -> Column:
    """The greatest is the row that stays: with an id, the largest, then the first row."""
    return F.struct(F.col(key).isNotNull().alias("has"), F.col(key).alias("key"), (-F.col("row")).alias("row"))


def exact_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    modulus: int = MODULUS,
    base: int = BASE,
    spread: int = SPREAD,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """(key, keep, group_size, kept, sha256): each document's group of equal texts and the one that stays of it.

    Documents are numbered and written to the shared folder once; fingerprints
    are a table of a few numbers a document. Texts of candidates are read again.
    ``modulus`` is below 2**61. Groups of a ``hot_share``-th of all rows or more
    are joined from a broadcast of at most ``hot_share`` rows, all other groups
    by shuffle, so no group fills a task.
    """
    body = whole_text(text)
    numbered = saved(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(key).alias("key"),
            F.octet_length(body).cast("long").alias("n"),
            F.sha2(body.cast("binary"), 256).alias("sha256"),
            body.alias("text"),
        ),
        "numbered",
    )
    prints = saved(_fingerprinted(numbered, modulus, base, spread, keep=False), "fingerprints")
    rows = _fingerprinted(numbered.select("row", "n", "text"), modulus, base, spread, keep=True)
    multiple = saved(prints.groupBy("fp", "n").agg(F.count("*").alias("c")).filter("c > 1").select("fp", "n"), "multiple")
    differing = saved(_differing(rows, multiple), "differing")
    whole = F.array().cast("array<bigint>")
    if differing.isEmpty():
        classes = prints.withColumn("class", whole)
    else:
        parts = _split(rows, differing)
        classes = prints.join(parts, "row", "left").withColumn("class", F.coalesce("class", whole))
    group = ["n", "fp", "class"]
    members = classes.select("row", "key", "sha256", *group)
    groups = members.groupBy(*group).agg(F.count("*").alias("group_size"), F.max(_order("key")).alias("best"))
    groups = saved(groups.filter("group_size > 1"), "groups")
    hot = F.col("group_size") >= F.lit(max(2, -(-prints.count() // hot_share)))
    known = members.join(F.broadcast(groups.filter(hot)), group, "left")
    rest = known.filter(F.col("group_size").isNull()).drop("group_size", "best")
    found = known.filter(F.col("group_size").isNotNull()).unionByName(rest.join(groups.filter(~hot), group, "left"))
    alone = F.col("group_size").isNull()
    return found.select(
        F.col("key").alias(key),
        F.when(alone, F.col("key")).otherwise(F.col("best.key")).alias("keep"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("best.row") == -F.col("row"))).alias("kept"),
        "sha256",
    )
