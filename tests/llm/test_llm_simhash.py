import numpy as np
import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from llm_cases import LONG, TEXTS, docs, key_order, words

from hitloom.llm.components import components
from hitloom.llm.simhash import majority_bits, near_duplicates, near_pairs


def fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_groups_equal_brute_force(spark):
    words_ = LONG.split()
    near = [(100 + k, " ".join(words_[: 3000 - k])) for k in range(6)]
    rows = TEXTS + near
    prints = [fingerprint(t) for _, t in rows]
    of = brute_components(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[of[p]] = min(least.get(of[p], i), i)
    expected = [(i, signed(p), least.get(of[p])) for (i, _), p in zip(rows, prints)]
    found = near_duplicates(docs(spark, rows)).collect()
    assert sorted(map(tuple, found), key=key_order) == sorted(expected, key=key_order)
    assert len({least.get(of[p]) for p in prints[len(TEXTS) :]}) < len(near)


def test_empty_table(spark):
    assert near_duplicates(docs(spark, [])).collect() == []


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_no_pair_is_lost(spark, distance):
    rng = np.random.default_rng(distance)
    centres = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    prints = set()
    for c in centres.tolist():
        prints.add(c)
        for _ in range(12):
            flips = rng.choice(64, rng.integers(1, 6), replace=False).tolist()
            prints.add(c ^ sum(1 << b for b in flips))
    values = sorted(signed(p) for p in prints)
    unsigned = {v: v % (1 << 64) for v in values}
    expected = {
        (a, b) for k, a in enumerate(values) for b in values[k + 1 :] if (unsigned[a] ^ unsigned[b]).bit_count() <= distance
    }
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    assert {tuple(r) for r in near_pairs(df, distance).collect()} == expected


def test_distance_beyond_the_segments_is_refused(spark):
    with pytest.raises(ValueError, match="distance"):
        near_pairs(spark.createDataFrame([], "fp long"), 4)


def test_majority_of_even_counts_needs_more_than_half():
    hashes = np.array([1, 3, 2], dtype=np.int64)
    assert majority_bits(hashes, np.array([0, 2, 3, 3])).tolist() == [1, 2, 0]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components_equal_brute_force(spark, edges):
    nodes = sorted({n for e in edges if e[0] != e[1] for n in e})
    pairs = {frozenset(e) for e in edges}
    expected = brute_components(nodes, lambda a, b: frozenset((a, b)) in pairs)
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.root for r in components(df).collect()} == expected


def test_a_long_chain_is_one_component(spark):
    df = spark.range(300).selectExpr("id as a", "id + 1 as b")
    assert {r.root for r in components(df).collect()} == {0}
