"""SimHash near-duplicates: fingerprints, links within a few bits, and their components.

A fingerprint has a bit for each of the 64 bits of the shingles' hashes: set if
it is set in more than half of them. Links are found by the pigeonring
principle: cut the 64 bits into four segments on a ring; if two fingerprints
differ in at most ``d`` bits, some segment starts a chain whose first ``l``
segments together differ in at most ``l * d / 4`` bits, for every ``l``. With
``d = 3`` the chain's first segment is equal, the first two differ in at most
one bit, the first three in at most two. The first two conditions are an equal
join on 32 bits (one side lists its variants of the second segment), the rest
prunes pairs before the full distance is taken. Keys of 32 bits keep buckets
small however many fingerprints there are; no pair is lost.

Copies share a fingerprint and are grouped before the search, so a group of
copies of any size is one fingerprint there. Only links within the distance
between different fingerprints are emitted.

Defined cases: null or empty text, or text without words, has fingerprint zero,
linked like any other; fewer words than a shingle make one shingle; repeated
rows give repeated result rows; a null id never becomes a component id unless
all ids of the component are null; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import fold_ascii, saved, shingles, whole_text, words
from hitloom.llm.components import components

SEGMENTS = 4
WIDTH = 64 // SEGMENTS
MASK = (1 << WIDTH) - 1

#: Shingles whose bits are counted at a time (64 bytes each).
_BLOCK = 1 << 16


def majority_bits(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One fingerprint per run of hashes; run k is ``hashes[ends[k]:ends[k + 1]]``."""
    totals = np.zeros((len(ends) - 1, 64), dtype=np.int64)
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    for at in range(0, len(hashes), _BLOCK):
        part = np.ascontiguousarray(hashes[at : at + _BLOCK]).view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little")
        mine = owner[at : at + _BLOCK]
        starts = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
        totals[mine[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    over = 2 * totals > np.diff(ends)[:, None]
    return np.packbits(over, axis=1, bitorder="little").view(np.int64).ravel()


def _fingerprint_batches(batches):
    for batch in batches:
        lists = batch.column("h")
        ends = lists.offsets.to_numpy().astype(np.int64)
        hashes = lists.values.to_numpy()[ends[0] : ends[-1]]
        made = majority_bits(hashes, ends - ends[0])
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made)], names=["id", "fp"])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(id, fp) for every row; shingles are hashed in the JVM, bits are counted in numpy."""
    id_type = dict(docs.dtypes)[key]
    hashed = docs.select(F.col(key).alias("id"), words(fold_ascii(whole_text(text))).alias("w")).select(
        "id", shingles(F.col("w"), width, lambda *x: F.xxhash64(F.concat_ws(" ", *x))).alias("h")
    )
    return hashed.mapInArrow(_fingerprint_batches, f"id {id_type}, fp long")


def segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit(MASK))


def near_pairs(fps: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b) with a < b for all different fingerprints ``fp`` within the distance.

    ``distance`` may be 0 to 3; ``fps`` has each fingerprint once.
    """
    if not 0 <= distance < SEGMENTS:
        raise ValueError(f"distance must be below {SEGMENTS}: the first segment of a chain is matched exactly")
    second = (2 * distance) // SEGMENTS  # bits in which the first two segments may differ
    flips = [0, *(1 << b for b in range(WIDTH))] if second else [0]
    fp = F.col("fp")
    exact = [F.struct(F.lit(i).alias("i"), segment(fp, i).alias("s"), segment(fp, i + 1).alias("t")) for i in range(SEGMENTS)]
    chains = fps.select(fp.alias("b"), F.explode(F.array(*exact)).alias("k")).select("b", "k.*")
    probes = (
        fps.select(fp.alias("a"), F.explode(F.array(*exact)).alias("k"))
        .select("a", "k.i", "k.s", F.col("k.t").alias("t0"))
        .select("a", "i", "s", F.explode(F.transform(F.array(*map(F.lit, flips)), lambda x: F.col("t0").bitwiseXOR(x.cast("long")))).alias("t"))
    )
    a, b = F.col("a"), F.col("b")
    apart = a.bitwiseXOR(b)
    ring = F.lit(False)
    for i in range(SEGMENTS):
        three = sum(F.bit_count(segment(apart, i + j)) for j in range(3))
        ring = ring | ((F.col("i") == i) & (three <= (3 * distance) // SEGMENTS))
    found = probes.join(chains, ["i", "s", "t"]).filter(a < b).filter(ring).filter(F.bit_count(apart) <= distance)
    return found.select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, distance: int = 3
) -> DataFrame:
    """(key, fp, component) for every row; the component is the smallest key that links reach."""
    marked = saved(fingerprints(docs, key, text, width), "fingerprints")
    distinct = saved(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    linked = components(near_pairs(distinct.select("fp"), distance))
    roots = distinct.join(linked, distinct.fp == linked.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = roots.groupBy("root").agg(F.min("least").alias("component"))
    named = roots.join(least, "root").select("fp", "component")
    return marked.join(named, "fp").select(F.col("id").alias(key), "fp", "component")
