import hashlib
from collections import defaultdict

import pytest
from helpers import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import LONG, TEXTS, docs, key_order
from oracle_check import connect, differences

from hitloom.llm.exact_dedup import CHUNK, chunk_hash, digits, exact_duplicates, fingerprint, shifted
from hitloom.llm.queries import ORACLE_SQL, QUERIES

P, B = 1_000_003, 7_919

ROWS = TEXTS + [
    (50, "x" * 300_000),
    (51, "x" * 300_000),
    (52, "x" * 299_999 + "y"),
    (53, "y" + "x" * 299_999),
    (60, "ab"),
    (61, "ba"),
    (62, "ab"),
    (62, "ab"),
    (70, "\n" * 1_000_000),
    (71, "\n" * 1_000_000),
    (72, "é" * CHUNK),
    (73, LONG),
]


def polynomial(data, modulus, base):
    """By the definition: pairs of bytes as digits, each chunk's odd byte a digit of its own."""
    total = 0
    for low in range(0, len(data), CHUNK):
        part = data[low : low + CHUNK]
        for k in range(0, len(part), 2):
            total = (total * base + int.from_bytes(part[k : k + 2], "little")) % modulus
    return total


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.integers(0, 3), st.integers(2, (1 << 61) - 1))
def test_fingerprint_is_the_polynomial_of_the_whole(data, chunks, base):
    data = (b"\xff\xfe" * (CHUNK // 2)) * chunks + data
    for modulus in ((1 << 61) - 1, P, 2):
        assert fingerprint(data, modulus, base % modulus) == polynomial(data, modulus, base % modulus)


def test_hashes_of_parts_combine_in_any_order():
    a, b, c = b"some bytes", b"more of them!", b"\0\0"
    a += b"" if len(a) % 2 == 0 else b"-"
    b += b"" if len(b) % 2 == 0 else b"-"
    shares = [
        shifted(chunk_hash(c, P, B), 0, P, B),
        shifted(chunk_hash(a, P, B), digits(len(b + c)), P, B),
        shifted(chunk_hash(b, P, B), digits(len(c)), P, B),
    ]
    assert sum(shares) % P == fingerprint(a + b + c, P, B)


def brute(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    best = {t: max((k for k in keys if k is not None), default=None) for t, keys in groups.items()}
    return groups, [
        (key, best[text or ""], len(groups[text or ""]), hashlib.sha256((text or "").encode()).hexdigest())
        for key, text in rows
    ]


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"spread": 100_000},  # long texts are hashed in parts
        {"modulus": 7, "base": 3},  # most fingerprints collide
        {"modulus": 7, "base": 3, "spread": 10, "hot_share": 2},
    ],
)
def test_groups_equal_brute_force(spark, options):
    groups, expected = brute(ROWS)
    found = exact_duplicates(docs(spark, ROWS), **options).collect()
    assert sorted(((r.doc_id, r.keep, r.group_size, r.sha256) for r in found), key=key_order) == sorted(expected, key=key_order)
    stays = [r for r in found if r.kept]
    assert len(stays) == len(groups) and all(r.doc_id == r.keep for r in stays)


def test_empty_table(spark):
    assert exact_duplicates(docs(spark, [])).collect() == []


def test_other_keys(spark):
    rows = spark.createDataFrame([("b", "t", 1), ("a", "t", 2), (None, "u", 3)], "`the id` string, body string, fp int")
    found = {tuple(r)[:4] for r in exact_duplicates(rows, "the id", "body").collect()}
    assert found == {("b", "b", 2, True), ("a", "b", 2, False), (None, None, 1, True)}


def test_query_equals_its_sql(spark):
    name = "op13_exact_dedup"
    assert differences(QUERIES[name](spark, SF_SMALL), connect(SF_SMALL), ORACLE_SQL[name]) == []
