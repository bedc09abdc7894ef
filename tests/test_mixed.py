"""Fields that are an array in some hits only, against a walk over the parsed records."""

import json
import random
from collections import Counter
from itertools import product

import pytest
from helpers import bag

from hitloom.operators.columns import flat
from hitloom.operators.nested import unpack
from hitloom.plans.medallion import run_topics
from hitloom.sources.hits import ENVELOPE, read_hits
from hitloom.sources.mixed import with_mixed_arrays


def lines(spark, records):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "value string")


def read(spark, records):
    return with_mixed_arrays(lines(spark, records), ENVELOPE)


def walk(value, name):
    """Rows of flat names to values; an empty array is one row without values."""
    if isinstance(value, dict):
        parts = [walk(v, f"{name}.{k}" if name else k) for k, v in value.items()]
        return [{k: v for part in parts for k, v in part.items()} for parts in product(*parts)]
    if isinstance(value, list):
        return [row for v in value or [None] for row in walk(v, name)]
    return [{name: value}]


def test_rows_equal_a_walk_over_the_records(spark):
    rng = random.Random(8)

    def some(value):
        return rng.choice([value, value, [value], [value, value], [], None])

    def part():
        return {"n": rng.randrange(9), "tag": some(rng.choice("xy")), "deep": some({"k": some(rng.randrange(5))})}

    records = [{"_id": str(i), "_score": None, "one": rng.random() < 0.5, "tag": some("t"), "part": some(part())} for i in range(150)]
    frame = unpack(read(spark, records))
    names = ["_id", "one", "tag", "part.n", "part.tag", "part.deep.k"]
    assert sorted(frame.columns) == sorted([*names, "_score"])
    expected = Counter(tuple(row.get(c) for c in names) for r in records for row in walk(r, ""))
    assert bag(frame.select(*(flat(c) for c in names))) == expected


@pytest.mark.parametrize(
    ("values", "dtype", "rows"),
    [
        (["a", 1], "string", ["a", "1"]),  # never an array: text, as inference has it
        ([{"k": 1}, "t"], "string", ['{"k":1}', "t"]),
        ([1, 0.5], "double", [1.0, 0.5]),
        ([1, [2, None]], "array<bigint>", [[1], [2, None]]),
        (["a", [1, True]], "array<string>", [["a"], ["1", "true"]]),
        ([{"k": 1}, [{"k": 2}, "t"]], "array<string>", [['{"k":1}'], ['{"k":2}', "t"]]),
        ([[1], [[2, 3]]], "array<array<bigint>>", [[[1]], [[2, 3]]]),
        ([None, [None]], "array<string>", [None, [None]]),
        ([10**19, 1], "decimal(20,0)", [10**19, 1]),
        ([[], "a", None], "array<string>", [[], ["a"], None]),
    ],
)
def test_types(spark, values, dtype, rows):
    frame = read(spark, [{"n": k, "f": v} for k, v in enumerate(values)])
    assert dict(frame.dtypes)["f"] == dtype
    assert [r.f for r in frame.orderBy("n").collect()] == rows


def test_names_that_need_quoting(spark):
    frame = read(spark, [{"a.b": {"c`d": 1, "OBJECT<": 2}}, {"a.b": [{"c`d": [3]}]}])
    rows = unpack(frame)
    assert sorted(rows.columns) == ["a.b.OBJECT<", "a.b.c`d"]
    assert sorted(map(tuple, rows.select(flat("a.b.c`d"), flat("a.b.OBJECT<")).collect())) == [(1, 2), (3, None)]


def test_files(spark, tmp_path):
    (tmp_path / "hits").mkdir()
    (tmp_path / "hits" / "a.json").write_text('{"_id":"1","x":1}\n\n{"_id":"2","x":[2,3]}\n')
    frame = read_hits(spark, str(tmp_path / "hits"), mixed_arrays=True)
    assert bag(unpack(frame)) == Counter([("1", 1), ("2", 2), ("2", 3)])
    (tmp_path / "hits" / "a.json").write_text("")
    assert read_hits(spark, str(tmp_path / "hits"), mixed_arrays=True).count() == 0
    for bad in ("[1,2]\n", '{"a":1\n'):
        (tmp_path / "hits" / "a.json").write_text('{"a":2}\n' + bad)
        with pytest.raises(Exception, match="(?i)json|objects|malformed"):
            read_hits(spark, str(tmp_path / "hits"), mixed_arrays=True).collect()
    with pytest.raises(ValueError, match="own schema"):
        read_hits(spark, "x", schema="a int", mixed_arrays=True)


def test_topic_with_mixed_arrays(spark, tmp_path):
    hits = [{"_id": f"G{k}", "_index": "g", "_score": None, "sort": [k], "_source": {"nhle_id": k, "area_id": a}} for k, a in enumerate(["C1", ["C2", "C3"], []])]
    (tmp_path / "export.json").write_text("\n".join(map(json.dumps, hits)))
    gold = run_topics(spark, {"grant-aided-places": str(tmp_path / "export.json")}, str(tmp_path / "lake"), mixed_arrays=True)
    rows = gold["grant-aided-places"].select("Id", "AreaId", "ConcatenatedId")
    assert bag(rows) == Counter([("G0", "C1", "G0C1"), ("G1", "C2", "G1C2"), ("G1", "C3", "G1C3"), ("G2", None, None)])
