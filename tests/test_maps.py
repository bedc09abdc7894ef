"""Objects whose keys are data."""

from collections import Counter

import pytest
from helpers import bag
from pyspark.sql.types import StructType

from hitloom.operators.columns import flat
from hitloom.operators.maps import explode_maps_outer, map_columns, map_keys, objects_as_maps, pivot_map
from hitloom.operators.nested import unpack
from hitloom.sources.hits import read_hits

ROWS = [("1", {"a": 1, "b": 2}, {"x": [1, 2]}), ("2", {}, None), ("3", None, {"y": []}), ("4", {"b.c": None}, {"z": [3]})]
SCHEMA = "id string, m map<string,int>, deep map<string,array<int>>"


def test_entries_are_rows_and_siblings_multiply(spark):
    rows = unpack(spark.createDataFrame(ROWS, SCHEMA), maps=True)
    assert rows.columns == ["id", "m.key", "m.value", "deep.key", "deep.value"]
    assert bag(rows) == Counter(
        [("1", k, v, "x", e) for k, v in (("a", 1), ("b", 2)) for e in (1, 2)]
        + [("2", None, None, None, None), ("3", None, None, "y", None), ("4", "b.c", None, "z", 3)]
    )
    assert map_columns(unpack(spark.createDataFrame(ROWS, SCHEMA))) == ["m", "deep"]  # unless asked for


def test_maps_of_objects_in_arrays(spark):
    df = spark.createDataFrame([([{"k": {"v": 1, "w": [5, 6]}}, {}, None],)], "a array<map<string,struct<v:int,w:array<int>>>>")
    rows = unpack(df, maps=True)
    assert rows.columns == ["a.key", "a.value.v", "a.value.w"]
    assert bag(rows) == Counter([("k", 1, 5), ("k", 1, 6), (None, None, None), (None, None, None)])


def test_pivot(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert map_keys(df, "m") == ["a", "b", "b.c"]
    made = pivot_map(df, "m")
    assert made.columns == ["id", "deep", "m.a", "m.b", "m.b.c"]
    assert bag(made.select("id", flat("m.a"), flat("m.b"), flat("m.b.c"))) == Counter(
        [("1", 1, 2, None), ("2", None, None, None), ("3", None, None, None), ("4", None, None, None)]
    )
    assert pivot_map(df, "m", keys=["b", "later"]).columns == ["id", "deep", "m.b", "m.later"]
    with pytest.raises(ValueError, match="more than 2 different keys"):
        pivot_map(df, "m", limit=2)
    with pytest.raises(ValueError, match="clash"):
        pivot_map(df.withColumnRenamed("id", "m.a"), "m")
    assert explode_maps_outer(df, ["m"]).columns == ["id", "deep", "m.key", "m.value"]


@pytest.mark.parametrize(
    ("fields", "value"),
    [
        ("a: bigint, b: bigint", "bigint"),
        ("a: bigint, b: double", "double"),
        ("a: bigint, b: string", "string"),
        ("a: struct<x: bigint>, b: struct<y: string, x: double>", "struct<x:double,y:string>"),
        ("a: array<bigint>, b: array<double>", "array<double>"),
        ("a: array<bigint>, b: bigint", "string"),
    ],
)
def test_values_get_one_type(fields, value):
    made = objects_as_maps(StructType.fromDDL(f"id string, s struct<m: struct<{fields}>>"), ["s.m"])
    assert made["s"].dataType["m"].dataType.simpleString() == f"map<string,{value}>"


def test_read_as_maps(spark, tmp_path):
    (tmp_path / "hits.json").write_text('{"_id":"1","list":[{"o":{"k1":1,"k2":2}}]}\n{"_id":"2","list":[{"o":{"k3":0.5}},{}]}\n')
    schema = objects_as_maps(read_hits(spark, str(tmp_path)).schema, ["list.o"])
    rows = unpack(read_hits(spark, str(tmp_path), schema=schema), maps=True)
    assert bag(rows) == Counter([("1", "k1", 1.0), ("1", "k2", 2.0), ("2", "k3", 0.5), ("2", None, None)])
    with pytest.raises(ValueError, match="no such object: list.absent"):
        objects_as_maps(schema, ["list.absent"])
