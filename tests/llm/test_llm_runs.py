import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import TEXTS, docs, key_order, words

from hitloom.llm import runs
from hitloom.llm.queries import QUERIES
from hitloom.llm.runs import COVER, STEP, Extensions, find_runs, periodic_runs


def brute_runs(w, least=12):
    """(start, length, period) by the definition: stretches that no neighbouring word extends, smallest periods."""
    n, found = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def collapsed(w, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_cover_reaches_every_difference():
    assert {(a - b) % STEP for a in COVER for b in COVER} == set(range(STEP))


SEQUENCE = st.one_of(
    st.lists(st.integers(1, 2), max_size=80),
    st.lists(st.integers(1, 30), max_size=60),
    st.tuples(st.lists(st.integers(1, 3), min_size=1, max_size=30), st.integers(1, 8), st.lists(st.integers(1, 3), max_size=5)).map(
        lambda x: x[2] + x[0] * x[1] + x[2]
    ),
)


@settings(max_examples=150, deadline=None)
@given(st.lists(SEQUENCE, min_size=1, max_size=5), st.sampled_from([2, 5, 12]))
def test_runs_equal_brute_force(sequences, least):
    found = find_runs([np.array(s, dtype=np.int64) for s in sequences], least)
    assert [tuple(r) for r in found.tolist()] == [
        (k, s, n, p) for k, w in enumerate(sequences) for s, n, p in sorted(brute_runs(w, least), key=lambda r: (r[0], r[2]))
    ]


@settings(max_examples=60, deadline=None)
@given(SEQUENCE.filter(lambda s: len(s) > 1), st.data())
def test_extensions_equal_brute_force(sequence, data):
    w = np.array([*sequence, 99], dtype=np.int64)
    i = data.draw(st.lists(st.integers(0, len(w) - 1), min_size=1, max_size=10))
    j = [(x + data.draw(st.integers(1, len(w) - 1))) % len(w) for x in i]
    expected = [next(k for k in range(len(w)) if max(a, b) + k >= len(w) or w[a + k] != w[b + k]) for a, b in zip(i, j)]
    assert Extensions(w)(np.array(i), np.array(j)).tolist() == expected


def test_blocks_and_portions_do_not_matter(monkeypatch):
    rng = np.random.default_rng(3)
    sequences = [np.tile(rng.integers(1, 4, 7), 9), rng.integers(1, 3, 200), np.ones(50, dtype=np.int64)]
    whole = find_runs(sequences).tolist()
    monkeypatch.setattr(runs, "BLOCK_PAIRS", 3)
    assert find_runs(sequences).tolist() == whole


LOOPS = [
    (100, "a b c d " * 10 + "tail"),
    (101, "start " + "w " * 2_000 + "end of it"),
    (102, "one two three " * 4 + "x y " * 7 + "one two three " * 4),
    (103, " ".join(f"u{i}" for i in range(40))),
    (104, "x " * 11),
    (105, "z" * 1_000_000 + " z"),
    (106, " " * 1_000_000),
    (107, "é 漢字  " * 8),
]


def test_rows_equal_brute_force(spark, monkeypatch):
    rows = TEXTS + LOOPS
    frame = docs(spark, rows).selectExpr("doc_id", "filter(split(text, '[ \\\\t-\\\\r]+'), x -> x <> '') AS words", "kept", "h")
    expected = []
    for key, text in rows:
        found = brute_runs(words(text)) if len(words(text)) < 5_000 else []
        expected.append((key, found, collapsed(words(text), found)))
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(frame).collect()]
    assert sorted(got, key=key_order) == sorted(expected, key=key_order)


def test_null_words_and_empty_table(spark):
    frame = spark.createDataFrame([("k", [None, "a"] * 8), ("e", []), (None, None)], "`the key` string, tokens array<string>")
    found = periodic_runs(frame, "tokens", "the key").collect()
    assert sorted((tuple(r) for r in found), key=key_order) == sorted(
        [("k", [(0, 16, 2)], "a"), ("e", [], ""), (None, [], "")], key=key_order
    )
    assert periodic_runs(frame.limit(0), "tokens", "the key").collect() == []


def contract_row(key, text):
    w, h = words(text), zlib.crc32(b"" if key is None else str(key).encode())
    n, g = len(w), h // 10
    if key is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(found, key=lambda r: (r[0], r[2])))
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    return (key, len(found), *best, exponent, sha(lines), sha(collapsed(w, found)))


@pytest.mark.parametrize("folder", [None, "/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, tmp_path, folder):
    if folder is None:
        many = [(1_000 + k, " ".join(f"w{(k * i) % 17}" for i in range(40 + k))) for k in range(60)]
        docs(spark, LOOPS + many + [t for t in TEXTS if len(t[1] or "") < 20_000]).write.parquet(str(tmp_path / "documents.parquet"))
        folder = str(tmp_path)
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = [r for r in rows if len(words(r.text)) <= 3_000]
    expected = [contract_row(*r) for r in rows]
    assert sum(r[1] > 0 for r in expected) > 10
    keys = {r.doc_id for r in rows}
    found = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, folder).collect() if r.doc_id in keys]
    assert sorted(found, key=key_order) == sorted(expected, key=key_order)
