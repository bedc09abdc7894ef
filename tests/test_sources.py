"""Reading hits, landing bronze, narrowing schemas and writing layers."""

import json
import random
from collections import Counter
from pathlib import Path

import pytest
from helpers import SF_SMALL, bag, plan
from pyspark.errors import PySparkException
from pyspark.sql.types import StructType

from hitloom.operators.nested import unpack
from hitloom.sources.hits import land_bronze, narrow_schema, read_hits, split_rejects, write_bronze
from hitloom.sources.tables import layer_path, read_table, write_table
from hitloom.workload import records


def _hits(n, seed=1):
    """Hits whose texts look like the layout around them."""
    rng = random.Random(seed)
    tricky = ["\n    },\n    {", "}\n]", "[", "plain", "é漢字", '"quoted" \\ back', "    }", ""]
    return [
        {
            "_id": f"A{i}",
            "_score": None,
            "sort": [i],
            "_source": {
                "text": "".join(rng.choices(tricky, k=rng.randint(0, 6))),
                "parts": [{"n": rng.randint(0, 9), "t": rng.choice(tricky)} for _ in range(rng.randint(0, 3))],
                "last": [{"z": 1}],
            },
        }
        for i in range(n)
    ]


def _bronze_objects(path):
    lines = [
        line
        for part in sorted(Path(path).glob("part-*"))
        for line in part.read_text().split("\n")
        if line.strip()
    ]
    return sorted((json.loads(line) for line in lines), key=lambda h: int(h["_id"][1:]))


def test_lines_are_copied_unchanged(spark, tmp_path):
    source = '{"_id":"A0", "n": 1.50, "d":NaN}\n\n{"n":1e3,"_id":"A1"}\n'
    (tmp_path / "x.json").write_text(source)
    land_bronze(spark, str(tmp_path / "x.json"), str(tmp_path / "bronze"))
    copied = "".join(p.read_text() for p in sorted((tmp_path / "bronze").glob("part-*")))
    assert copied == source.replace("\n\n", "\n")


@pytest.mark.parametrize("split_bytes", ["64", "1000", "128MB"])
@pytest.mark.parametrize("indent", [2, 4])
def test_an_indented_array_is_split_exactly(spark, tmp_path, conf, split_bytes, indent):
    hits = _hits(40)
    for n, part in enumerate((hits[:25], hits[25:26], hits[26:], [])):
        (tmp_path / f"export-{n}.json").write_text(json.dumps(part, indent=indent))
    conf(spark__sql__files__maxPartitionBytes=split_bytes, spark__sql__files__openCostInBytes="1")
    land_bronze(spark, str(tmp_path / "export-*.json"), str(tmp_path / "bronze"), "indented", indent)
    assert _bronze_objects(tmp_path / "bronze") == hits
    if split_bytes == "1000":
        assert len(list((tmp_path / "bronze").glob("part-*"))) > 4


def test_a_wrong_indent_fails_instead_of_losing_hits(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps(_hits(3), indent=2))
    with pytest.raises(PySparkException, match="indented by 4"):
        land_bronze(spark, str(tmp_path / "x.json"), str(tmp_path / "bronze"), "indented", 4)


def test_any_array_can_land_as_a_document(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps(_hits(5)))
    land_bronze(spark, str(tmp_path / "x.json"), str(tmp_path / "bronze"), "document")
    assert _bronze_objects(tmp_path / "bronze") == _hits(5)


@pytest.mark.parametrize("inside", ["bronze", "bronze/", "bronze/x.json"])
def test_an_export_inside_bronze_is_not_deleted(spark, tmp_path, inside):
    (tmp_path / "bronze").mkdir()
    (tmp_path / "bronze" / "x.json").write_text("{}")
    with pytest.raises(ValueError, match="inside"):
        land_bronze(spark, str(tmp_path) + "/" + inside, str(tmp_path / "bronze"))
    assert (tmp_path / "bronze" / "x.json").exists()


def test_unknown_layout(spark, tmp_path):
    with pytest.raises(ValueError, match="layout"):
        land_bronze(spark, "x", str(tmp_path / "bronze"), "csv")


def test_all_layouts_read_back_the_same(spark, tmp_path):
    hits = _hits(12)
    (tmp_path / "doc.json").write_text(json.dumps(hits, indent=4))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(h) for h in hits))
    expected = read_hits(spark, str(tmp_path / "doc.json"), multiLine="true")
    for export, layout in (("doc", "document"), ("doc", "indented"), ("lines", "lines")):
        bronze = str(tmp_path / f"bronze-{layout}")
        land_bronze(spark, str(tmp_path / f"{export}.json"), bronze, layout)
        assert read_hits(spark, bronze).schema == expected.schema
        assert bag(unpack(read_hits(spark, bronze))) == bag(unpack(expected))


def test_landing_replaces_what_was_there(spark, tmp_path):
    for n in (5, 2):
        (tmp_path / "x.json").write_text("\n".join(json.dumps(h) for h in _hits(n)))
        land_bronze(spark, str(tmp_path / "x.json"), str(tmp_path / "bronze"))
    assert _bronze_objects(tmp_path / "bronze") == _hits(2)


def test_bronze_keeps_null_fields_and_infinities(spark, tmp_path):
    df = spark.sql("select 'a' as _id, cast(null as string) as empty, double('-inf') as d")
    write_bronze(df, str(tmp_path / "bronze"))
    back = read_hits(spark, str(tmp_path / "bronze"), schema=df.schema)
    assert back.first() == ("a", None, float("-inf"))
    assert set(read_hits(spark, str(tmp_path / "bronze")).columns) == {"_id", "empty", "d"}


def test_inference_widens_conflicting_types_to_string(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"v": 1, "w": 1}\n{"v": "x", "w": 1.5}\n')
    assert dict(read_hits(spark, str(tmp_path / "x.json")).dtypes) == {"v": "string", "w": "double"}


@pytest.mark.parametrize("layout", ["document", "indented"])
def test_many_documents_land_together(spark, tmp_path, layout):
    hits = records.order_hits(spark, SF_SMALL)
    records.write_documents(records.hit_lines(hits), str(tmp_path / "export"), document_bytes=20_000)
    files = list((tmp_path / "export").glob("part-*"))
    assert len(files) > 10 and all(f.stat().st_size < 21_000 for f in files)
    assert sum(len(json.loads(f.read_text())) for f in files) == hits.count()
    land_bronze(spark, str(tmp_path / "export"), str(tmp_path / "bronze"), layout)
    landed = read_hits(spark, str(tmp_path / "bronze"), schema=hits.schema)
    assert bag(unpack(landed)) == bag(unpack(hits))


def test_hits_come_in_any_format(spark, tmp_path):
    hits = records.areas_hits(spark, SF_SMALL)
    hits.write.parquet(str(tmp_path / "hits"))
    assert read_hits(spark, str(tmp_path / "hits"), fmt="parquet").count() == hits.count()


NESTED = (
    "_id string, sort array<bigint>, _source struct<a: string, b: string, "
    "p: array<struct<x: string, y: string, q: array<struct<u: int, v: int>>>>, "
    "r: array<struct<only: string>>, s: struct<k: int, l: int>>"
)


def test_narrow_schema_keeps_named_scalars_and_every_array():
    narrowed = narrow_schema(StructType.fromDDL(NESTED), ["_source.a", "_source.p.x", "_source.p.q.v", "_source.s.l"])
    assert narrowed.simpleString() == StructType.fromDDL(
        "sort array<bigint>, _source struct<a: string, p: array<struct<x: string, q: array<struct<v: int>>>>, "
        "r: array<struct<only: string>>, s: struct<l: int>>"
    ).simpleString()


def test_narrowed_reads_give_the_same_rows(spark, tmp_path):
    write_bronze(records.area_by_numbers_hits(spark, SF_SMALL), str(tmp_path / "bronze"))
    full = read_hits(spark, str(tmp_path / "bronze"))
    names = ["_source.area_id", "_source.periods.name", "_source.periods.examples.url"]
    narrow = read_hits(spark, str(tmp_path / "bronze"), schema=narrow_schema(full.schema, names))
    columns = [f"`{n}`" for n in names]
    assert bag(unpack(narrow).select(columns)) == bag(unpack(full).select(columns))
    assert "unused" not in plan(unpack(narrow).select(columns))


def test_layer_paths():
    assert layer_path("s3://lake/", "areas", "gold") == layer_path("s3://lake", "areas", "gold") == "s3://lake/areas/gold"


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_tables_are_replaced_whole(spark, tmp_path, fmt):
    path = str(tmp_path / "table")
    write_table(spark.range(5).toDF("a.b"), path, fmt)
    write_table(spark.range(3).toDF("c"), path, fmt, schema_change="any")
    assert bag(read_table(spark, path, fmt)) == Counter([(0,), (1,), (2,)])


def test_write_options_reach_the_writer(spark, tmp_path):
    write_table(spark.range(0, 10, 1, 1), str(tmp_path / "t"), maxRecordsPerFile="4")
    assert len(list((tmp_path / "t").glob("part-*"))) == 3


# --- nothing is lost without a word -----------------------------------------------------

HIT = '{"_id":"%s","_index":"i","_score":null,"sort":[%d],"_source":{"name":"n","total":%s}}'
HITS_DDL = "_id string, _index string, _score double, sort array<bigint>, _source struct<name:string,total:bigint>"


def _lines(tmp_path, *lines):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "in")


@pytest.mark.parametrize("schema", [None, HITS_DDL])
def test_a_malformed_line_fails(spark, tmp_path, schema):
    path = _lines(tmp_path, HIT % (1, 1, 5), '{"_id":"2","_source":{"na')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_hits(spark, path, schema=schema).collect()


def test_a_value_of_another_type_than_the_schema_s_fails(spark, tmp_path):
    path = _lines(tmp_path, HIT % (1, 1, 5), HIT % (2, 2, '"many"'))
    with pytest.raises(Exception, match="(?i)malformed|cannot"):
        read_hits(spark, path, schema=HITS_DDL).collect()


@pytest.mark.parametrize("schema", [None, HITS_DDL])
def test_rejects_are_kept_apart(spark, tmp_path, schema):
    bad = ['{"_id":"2","_source":{"na', "[1]", "7"] + ([HIT % (4, 4, '"many"')] if schema else [])
    path = _lines(tmp_path, HIT % (1, 1, 5), *bad, "", HIT % (5, 5, "null"))
    good, rejected = split_rejects(spark, path, schema)
    assert sorted(r._id for r in good.collect()) == ["1", "5"]
    assert sorted(r.value for r in rejected.collect()) == sorted(bad)
    assert dict(good.dtypes)["_score"] == "double"


def test_the_envelope_has_its_types_whatever_was_inferred(spark, tmp_path):
    types = dict(read_hits(spark, _lines(tmp_path, HIT % (1, 1, 5))).dtypes)
    assert (types["_id"], types["_index"], types["_score"]) == ("string", "string", "double")


PRETTY = '[\n    {\n        "_id": "1",\n        "n": 1\n    },\n    {\n        "_id": "2",\n        "n": 2\n    }\n]'


def _export(tmp_path, text):
    (tmp_path / "export.json").write_text(text)
    return str(tmp_path / "export.json")


@pytest.mark.parametrize("end", [len(PRETTY) - 2, len(PRETTY) - 8, PRETTY.index('"n": 2') - 10, PRETTY.index("    },") + 6])
def test_a_truncated_indented_export_fails(spark, tmp_path, end):
    with pytest.raises(ValueError, match="cut off"):
        land_bronze(spark, _export(tmp_path, PRETTY[:end]), str(tmp_path / "b"), "indented")


@pytest.mark.parametrize("end", [len(PRETTY) - 2, PRETTY.index('"n": 2')])
def test_a_truncated_document_fails(spark, tmp_path, end):
    with pytest.raises(Exception, match="(?i)malformed"):
        land_bronze(spark, _export(tmp_path, PRETTY[:end]), str(tmp_path / "b"), "document")


def test_the_default_layout_refuses_an_array(spark, tmp_path):
    for k, text in enumerate((PRETTY, '[{"_id":"1"}]')):
        with pytest.raises(Exception, match="another layout"):
            land_bronze(spark, _export(tmp_path, text), str(tmp_path / f"b{k}"))


def test_documents_keep_each_hit_s_own_structure(spark, tmp_path):
    text = '[{"b": {"x": [1, {"y": null}]}, "a": 1},\n {"b": "text\\n\\u00e9", "c": {}}, {"b": 2}]'
    land_bronze(spark, _export(tmp_path, text), str(tmp_path / "b"), "document")
    found = [r.value for r in spark.read.text(str(tmp_path / "b")).collect()]
    assert [json.loads(v) for v in found] == json.loads(text)
    assert [list(json.loads(v)) for v in found] == [["b", "a"], ["b", "c"], ["b"]]


def test_one_object_and_an_empty_array_are_documents_too(spark, tmp_path):
    land_bronze(spark, _export(tmp_path, ' {"_id": "1"}\n'), str(tmp_path / "b1"), "document")
    assert [json.loads(r.value) for r in spark.read.text(str(tmp_path / "b1")).collect()] == [{"_id": "1"}]
    land_bronze(spark, _export(tmp_path, "[]\n"), str(tmp_path / "b2"), "document")
    assert spark.read.text(str(tmp_path / "b2")).count() == 0
