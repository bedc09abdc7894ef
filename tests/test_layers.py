"""What may replace a layer, and what a run reports."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hitloom.plans.medallion import run_topic
from hitloom.plans.topics import TOPICS
from hitloom.sources.tables import SchemaChange, read_table, schema_changes, stored_schema, write_table

OLD = "id int, name string, s struct<a: int, b: array<float>>, m map<string,int>, d decimal(10,2)"


@pytest.mark.parametrize(
    ("new", "widened", "broken"),
    [
        (OLD, 0, 0),
        ("name string, id int not null, d decimal(10,2), m map<string,int>, s struct<b: array<float>, a: int>", 0, 0),
        ("ID int, name string, s struct<A: int, b: array<float>>, m map<string,int>, d decimal(10,2)", 0, 0),
        (OLD.replace("id int", "id bigint"), 1, 0),
        (OLD.replace("id int", "id double"), 1, 0),
        (OLD.replace("id int", "id string"), 0, 1),
        (OLD.replace("id int", "id float"), 0, 1),
        (OLD.replace("float", "double"), 1, 0),
        (OLD.replace("a: int", "a: smallint"), 0, 1),
        (OLD.replace("a: int,", "a: int, c: int,"), 1, 0),
        (OLD.replace("a: int,", ""), 0, 1),
        (OLD.replace("<string,int>", "<string,bigint>"), 1, 0),
        (OLD.replace("(10,2)", "(12,3)"), 1, 0),
        (OLD.replace("(10,2)", "(11,4)"), 0, 1),
        (OLD.replace("name string, ", "label string, "), 1, 1),
        (OLD.replace("s struct<a: int, b: array<float>>", "s string"), 0, 1),
    ],
)
def test_relation_of_schemas(new, widened, broken):
    found = schema_changes(StructType.fromDDL(OLD), StructType.fromDDL(new))
    assert tuple(map(len, found)) == (widened, broken)


def test_names_by_case():
    old, new = StructType.fromDDL("id int"), StructType.fromDDL("ID int")
    assert schema_changes(old, new, by_case=True) == (["ID is new"], ["id is gone"])


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_an_incompatible_layer_leaves_the_old_one(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    assert stored_schema(spark, path, fmt) is None
    write_table(spark.range(5), path, fmt)
    with pytest.raises(SchemaChange, match="id was bigint, is string"):
        write_table(spark.range(9).select(F.concat(F.lit("x"), "id").alias("id")), path, fmt)
    with pytest.raises(SchemaChange, match="more is new"):
        write_table(spark.range(9).withColumn("more", F.lit(1)), path, fmt)
    assert read_table(spark, path, fmt).count() == 5
    write_table(spark.range(9).withColumn("more", F.lit(1)), path, fmt, schema_change="widen")
    with pytest.raises(SchemaChange, match="more is gone"):
        write_table(spark.range(9), path, fmt, schema_change="widen")
    write_table(spark.range(2), path, fmt, schema_change="any")
    assert read_table(spark, path, fmt).columns == ["id"]
    with pytest.raises(ValueError, match="expected"):
        write_table(spark.range(2), path, fmt, schema_change="perhaps")


def hit(k, **source):
    return {"_id": f"A{k}", "_index": "areas", "_score": None, "sort": [k], "_source": {"name": f"n{k}", **source}}


def export(path, hits):
    path.write_text("\n".join(map(json.dumps, hits)))
    return str(path)


def test_a_topic_refuses_another_schema(spark, tmp_path):
    root = str(tmp_path / "lake")
    run_topic(spark, TOPICS["areas"], root, export(tmp_path / "a.json", [hit(1, level=1)]))
    other = export(tmp_path / "b.json", [hit(1, level="one"), hit(2)])
    with pytest.raises(SchemaChange, match="level was bigint, is string"):
        run_topic(spark, TOPICS["areas"], root, other)
    assert read_table(spark, f"{root}/areas/silver").count() == 1
    assert run_topic(spark, TOPICS["areas"], root, other, schema_change="any").count() == 2
    run_topic(spark, TOPICS["areas"], root, export(tmp_path / "c.json", [hit(1, level="x", more=1)]), schema_change="widen")


def test_report(spark, tmp_path):
    root = str(tmp_path / "lake")
    hits = [hit(1, kind="k", hierarchy_children=["a", "b"]), hit(2), hit(3, kind="l")]
    path = export(tmp_path / "a.json", hits) + ""
    with open(path, "a", encoding="utf-8") as f:
        f.write('\n{"broken"\nno json\n')
    run_topic(spark, TOPICS["areas"], root, path, rejects=True)
    rows = {(r.metric, r["name"]): r.value for r in read_table(spark, f"{root}/areas/report").collect()}
    assert rows["hits", None] == 3 and rows["rejects", None] == 2 and rows["rows", None] == 4
    assert rows["nulls", "Kind"] == 1 and rows["nulls", "Title"] == 0 and rows["nulls", "Score"] == 4
    absent = {name for metric, name in rows if metric == "absent"}
    assert "_source.geometry" in absent and "_source.scope_note" in absent and "_source.kind" not in absent


def test_report_without_rejects(spark, tmp_path):
    root = str(tmp_path / "lake")
    run_topic(spark, TOPICS["areas"], root, export(tmp_path / "a.json", [hit(1), hit(2)]))
    metrics = [r.metric for r in read_table(spark, f"{root}/areas/report").collect()]
    assert metrics.count("hits") == 1 and "rejects" not in metrics
