import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import LONG, TEXTS, docs
from pyspark.sql import functions as F

from hitloom.llm import repeats as module
from hitloom.llm.repeats import maximal_groups, repeat_groups, repeats


def brute(rows):
    """(n_bytes, n_removed, spans, sha) per row, rows in order."""
    seen, made = set(), []
    for _, t in rows:
        b = (t or "").encode()
        mask = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                mask[s : s + 100] = b"\1" * 100
            seen.add(w)
        spans, at = [], 0
        while at < len(b):
            if mask[at]:
                end = at
                while end < len(b) and mask[end]:
                    end += 1
                spans.append((at, end))
                at = end
            else:
                at += 1
        left = bytes(x for x, m in zip(b, mask) if not m)
        made.append((len(b), sum(mask), spans, hashlib.sha256(left).hexdigest()))
    return made


def corpus():
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh ijé") for _ in range(n))
    passage, line = text(250), text(130)
    rows = [(100 + k, text(rng.randint(0, 400)) + passage[k % 60 : 190 + k % 50] + text(rng.randint(0, 300))) for k in range(40)]
    rows += [(200 + k, line + "\n" + text(50) + line + passage) for k in range(10)]
    rows += [(300, "x" * 1000), (301, "y" + "x" * 150), (302, "ab" * 300), (303, passage * 4), (304, "x" * 99), (305, "x" * 100)]
    rows += [(400 + k, text(99)) for k in range(3)] + [(500, LONG[:20_000]), (501, LONG[7:20_007]), (502, LONG[:20_000])]
    return rows


def check(spark, rows):
    found = {}
    for r in repeats(docs(spark, rows).repartition(5)).collect():
        value = (r.n_bytes, r.n_removed, [(s.start, s.end) for s in r.spans], r.kept_sha256)
        found.setdefault(r.doc_id, []).append(value)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    expected = {}
    for (i, _), value in zip(order, brute(order)):
        expected.setdefault(i, []).append(value)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}


def test_equal_brute_force(spark):
    check(spark, corpus())


@pytest.mark.parametrize("name, value", [("BLOCK", 1000), ("HELD_ANCHORS", 10), ("HELD_CONTEXTS", 10)])
def test_block_sizes_do_not_matter(spark, monkeypatch, name, value):
    monkeypatch.setattr(module, name, value)
    check(spark, corpus())


def test_unusual_rows(spark):
    # Two rows without an id (one empty) and two equal rows of one id.
    check(spark, [r for r in TEXTS if r[1] is None or len(r[1]) < 5000] + [(9, LONG[:3000]), (8, LONG[:3000])])


def test_rows_of_one_id_are_spread_and_joined_one_by_one(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rng = random.Random(6)
    line = "".join(rng.choice("abcdefgh ij") for _ in range(300))
    for i in (None, 7):
        rows = [(i, f"{k} " * 40 + line) for k in range(300)] + [(8, line)]
        base, spans = module.repeated_spans(docs(spark, rows))
        # The data of a document is its own, not that of all rows of its id.
        assert max(len(r[0]) for r in spans.select("spans").collect()) < 16 * 100
        sizes = [r["count"] for r in base.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 150
        found = repeats(docs(spark, rows)).collect()
        assert len(found) == 301 and sum(r.n_removed >= 300 for r in found) == 300


@pytest.mark.parametrize("hot, held", [(2, 10), (2, 1 << 17), (20, 500)])
def test_hot_anchors_are_split_without_loss(spark, monkeypatch, hot, held):
    monkeypatch.setattr(module, "HOT", hot)
    monkeypatch.setattr(module, "HELD_CONTEXTS", held)
    check(spark, corpus())


def test_no_bucket_gets_all_contexts_of_a_hot_anchor(spark, monkeypatch):
    monkeypatch.setattr(module, "HOT", 50)
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh ij") for _ in range(n))
    passage = text(150)
    rows = [(k, text(120) + passage + text(120)) for k in range(400)]
    base, owners, buckets = module._documents_of(docs(spark, rows), "doc_id", "text")
    marked = base.join(module._marked(base, owners, buckets), "row").select(*module._DOCUMENT, "marks", "doc_id")
    sent = marked.mapInArrow(module._send_contexts(16, owners), module._PART_DDL).filter("owner is null or owner = -1").collect()
    sizes = {}
    for r in sent:
        n = int.from_bytes(module.zstandard.ZstdDecompressor().decompress(r.data)[:8], "little")
        sizes[r.bucket] = sizes.get(r.bucket, 0) + n
    assert len(sizes) == 16 and max(sizes.values()) < 2 * sum(sizes.values()) / 16
    check(spark, rows)


def test_buckets_follow_bytes(spark, monkeypatch):
    rows = [(k, "x" * 1000) for k in range(50)]
    assert module._documents_of(docs(spark, rows), "doc_id", "text")[1:] == (4, 4)
    monkeypatch.setattr(module, "BUCKET_BYTES", 5000)
    assert module._documents_of(docs(spark, rows), "doc_id", "text")[1:] == (4, 10)
    check(spark, corpus())


def test_least_of_a_range():
    rng = random.Random(3)
    values = [rng.randrange(1000) for _ in range(700)]
    least = module._least_of(values)
    for a, b in ((0, 700), (1, 699), (0, 65), (100, 612), (5, 6), (635, 700)):
        assert least(a, b) == min(values[a:b])


def test_empty_table(spark):
    assert repeats(docs(spark, [])).count() == 0


def test_documents_are_shuffled_once(spark):
    df = repeats(docs(spark, corpus()))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 2


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=6), st.text("ab", max_size=6)), min_size=2, max_size=7, unique=True), st.integers(1, 8))
def test_groups_are_all_maximal_repeats_around_the_anchor(pairs, length):
    lefts, rights = [a.encode() for a, _ in pairs], [b.encode() for _, b in pairs]
    prefix = lambda xs: len(__import__("os").path.commonprefix(xs))
    expected = set()
    for left in range(7):
        for right in range(1, 7):
            if left + right < length:
                continue
            for key in {(a[:left], b[:right]) for a, b in zip(lefts, rights) if len(a) >= left and len(b) >= right}:
                group = [k for k, (a, b) in enumerate(zip(lefts, rights)) if a.startswith(key[0]) and b.startswith(key[1])]
                if len(group) > 1 and prefix([lefts[k] for k in group]) == left and prefix([rights[k] for k in group]) == right:
                    expected.add((left, right, tuple(sorted(group))))
    assert {(x, y, tuple(sorted(g))) for x, y, g in maximal_groups(lefts, rights, length)} == expected


def test_groups_list_all_occurrences(spark):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh ij") for _ in range(n))
    a, b = text(140), text(110)
    rows = [(1, text(60) + a + text(40)), (2, text(30) + a + b), (3, b + text(50) + a), (4, text(300)), (5, a), (6, a)]
    found = repeat_groups(docs(spark, rows)).collect()
    by_group = {}
    for r in found:
        by_group.setdefault((bytes(r["repeat"]), r.length), set()).add((r.doc_id, r.start))
    bytes_of = {i: t.encode() for i, t in rows}
    covered = {}
    for (_, length), places in by_group.items():
        strings = {bytes_of[i][s : s + length] for i, s in places}
        assert len(strings) == 1 and length >= 100 and len(places) > 1
        (string,) = strings
        everywhere = {(i, s) for i, t in bytes_of.items() for s in range(len(t)) if t.startswith(string, s)}
        assert places == everywhere
        for i, s in places:
            covered.setdefault(i, set()).update(range(s, s + length))
    # Together the groups cover what occurs more than once, first occurrences included.
    windows = {}
    for i, t in bytes_of.items():
        for s in range(len(t) - 99):
            windows.setdefault(t[s : s + 100], []).append((i, s))
    expected = {}
    for places in windows.values():
        if len(places) > 1:
            for i, s in places:
                expected.setdefault(i, set()).update(range(s, s + 100))
    assert covered == expected
