"""Topics from export to gold."""

import json
from collections import Counter
from pathlib import Path

import pytest
from helpers import SF_SMALL, bag
from pyspark.sql import functions as F
from test_topics import AREA, NUMBERS, STORY

from hitloom.plans.medallion import curate, run_topic, run_topics
from hitloom.plans.topics import TOPICS
from hitloom.sources.hits import BRONZE_FILES, read_hits, write_bronze
from hitloom.sources.tables import layer_path, read_table
from hitloom.workload import records
from hitloom.workload.queries import QUERIES


@pytest.fixture
def export(tmp_path):
    def write(name, *hits):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(hits, indent=4))
        return str(path)

    return write


def test_every_layer_is_written(spark, tmp_path, export):
    root = str(tmp_path / "lake")
    gold = run_topic(spark, TOPICS["areas"], root, export("areas", AREA), "indented")
    assert gold.count() == 2
    assert read_hits(spark, layer_path(root, "areas", "bronze")).first()["_id"] == "A1"
    for layer in ("silver", "gold"):
        assert bag(read_table(spark, layer_path(root, "areas", layer))) == bag(gold)


def test_topics_run_in_the_order_of_their_lookups(spark, tmp_path, export):
    exports = {"area-by-numbers": export("numbers", NUMBERS), "areas": export("areas", AREA)}
    gold = run_topics(spark, exports, str(tmp_path / "lake"), layout="indented")
    assert list(gold) == ["areas", "area-by-numbers"]
    # Each of three rows matches both rows that the area's two children made.
    assert bag(gold["area-by-numbers"].groupBy("PeriodName", "AreaId").count()) == Counter([("P1", 0, 4), ("P0", 0, 2)])


def test_unknown_topics_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="nowhere"):
        run_topics(spark, {"nowhere": "x"}, str(tmp_path))


def test_a_second_run_replaces_the_first(spark, tmp_path, export):
    root = str(tmp_path / "lake")
    run_topic(spark, TOPICS["areas"], root, export("areas", AREA), "indented")
    second = {**AREA, "_id": "B1", "_source": {**AREA["_source"], "hierarchy_children": []}}
    gold = run_topic(spark, TOPICS["areas"], root, export("areas", second), "indented")
    assert [r["Id"] for r in gold.collect()] == ["B1"]


def test_without_an_export_bronze_is_reused(spark, tmp_path, export):
    root = str(tmp_path / "lake")
    first = bag(run_topic(spark, TOPICS["areas"], root, export("areas", AREA), "indented"))
    schema = read_hits(spark, layer_path(root, "areas", "bronze")).schema
    assert bag(run_topic(spark, TOPICS["areas"], root, schema=schema)) == first


def test_load_time_is_the_same_in_silver_and_gold(spark, tmp_path, export):
    root = str(tmp_path / "lake")
    gold = run_topic(spark, TOPICS["stories"], root, export("stories", STORY), "indented")
    silver = read_table(spark, layer_path(root, "stories", "silver"))
    assert bag(gold.select("CreatedOn")) == bag(silver.select("CreatedOn"))


def test_gold_can_be_an_aggregate(spark, tmp_path, export):
    def per_kind(silver):
        return silver.groupBy("Kind").agg(F.count("*").alias("areas"))

    gold = run_topic(
        spark, TOPICS["areas"], str(tmp_path / "lake"), export("areas", AREA), "indented", gold_fn=per_kind
    )
    assert bag(gold) == Counter([("county", 2)])


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_exports_can_be_frames_and_tables_any_format(spark, tmp_path, fmt):
    hits = records.stories_hits(spark, SF_SMALL)
    gold = run_topic(spark, TOPICS["stories"], str(tmp_path / "lake"), hits, fmt=fmt, maxRecordsPerFile="400")
    expected = curate(hits, TOPICS["stories"]).drop("CreatedOn")
    assert bag(gold.select(expected.columns)) == bag(expected)
    assert len(list(Path(layer_path(str(tmp_path / "lake"), "stories", "gold")).glob("part-*"))) > 1


def test_paths_can_have_a_prefix_and_bronze_can_be_foreign(spark, tmp_path):
    for name, hit in (("areas", AREA), ("area-by-numbers", NUMBERS)):
        bronze = tmp_path / "lake" / f"my-{name}" / "bronze"
        bronze.mkdir(parents=True)
        (bronze / f"my-{name}.json").write_text(json.dumps([hit], indent=4))
        gold = run_topic(
            spark, TOPICS[name], str(tmp_path / "lake"), prefix="my-", bronze_options={"multiLine": "true"}
        )
    assert gold.count() == 6
    assert (tmp_path / "lake" / "my-area-by-numbers" / "gold").is_dir()


def test_names_in_other_case_give_the_same_rows_through_all_layers(spark, tmp_path, export):
    hit = json.loads(json.dumps(NUMBERS).replace('"area_id"', '"Area_ID"'))
    root = str(tmp_path / "lake")
    area = {"areas": {"layout": "indented"}}
    made = run_topics(
        spark,
        {"areas": export("areas", AREA), "area-by-numbers": export("numbers", hit)},
        root,
        topic_options=area,
        layout="document",
    )
    lookups = {"areas": made["areas"]}
    hits = read_hits(spark, layer_path(root, "area-by-numbers", "bronze"))
    assert bag(made["area-by-numbers"]) == bag(curate(hits, TOPICS["area-by-numbers"], lookups))
    assert made["area-by-numbers"].filter("AreaId is not null").count() > 0


def test_topics_have_options_of_their_own(spark, tmp_path, export):
    schemas = {
        name: spark.createDataFrame([], rows.schema).schema
        for name, rows in (("areas", records.areas_hits(spark, SF_SMALL)), ("stories", records.stories_hits(spark, SF_SMALL)))
    }
    exports = {}
    for name, rows in (("areas", records.areas_hits(spark, SF_SMALL)), ("stories", records.stories_hits(spark, SF_SMALL))):
        exports[name] = str(tmp_path / name)
        rows.limit(20).write.json(exports[name])
    options = {
        "areas": {"schema": schemas["areas"], "gold_fn": lambda df: df.groupBy("Kind").count()},
        "stories": {"schema": schemas["stories"]},
    }
    made = run_topics(spark, exports, str(tmp_path / "lake"), topic_options=options)
    assert made["areas"].columns == ["Kind", "count"] and "Title" in made["stories"].columns
    with pytest.raises(ValueError, match="unknown"):
        run_topics(spark, exports, str(tmp_path / "lake"), topic_options={"unknown": {}})


def test_indent_reaches_the_export(spark, tmp_path):
    path = tmp_path / "two.json"
    path.write_text(json.dumps([AREA], indent=2))
    gold = run_topic(spark, TOPICS["areas"], str(tmp_path / "lake"), str(path), "indented", indent=2)
    assert gold.count() == 2


def test_bad_lines_fail_a_topic_or_are_kept_as_rejects(spark, tmp_path):
    path = tmp_path / "numbers.json"
    path.write_text(json.dumps(NUMBERS) + "\n" + json.dumps(NUMBERS)[:-9] + "\n")
    root = str(tmp_path / "lake")
    records.areas_hits(spark, SF_SMALL).limit(3).write.json(str(tmp_path / "areas"))
    run_topic(spark, TOPICS["areas"], root, str(tmp_path / "areas"))
    with pytest.raises(Exception, match="(?i)malformed"):
        run_topic(spark, TOPICS["area-by-numbers"], root, str(path))
    gold = run_topic(spark, TOPICS["area-by-numbers"], root, str(path), rejects=True)
    assert gold.count() == 3 and gold.filter("PeriodName is null").count() == 0
    assert spark.read.text(layer_path(root, "area-by-numbers", "rejects")).count() == 1


def test_bronze_is_compressed_in_many_files(spark, tmp_path):
    hits = records.place_names_hits(spark, SF_SMALL)
    write_bronze(hits, str(tmp_path / "export"), maxRecordsPerFile="100")
    text = sum(len(r.value) for r in hits.selectExpr("to_json(struct(*), map('ignoreNullFields', 'false')) as value").collect())
    gold = {
        name: run_topic(spark, TOPICS["place-names"], str(tmp_path / name), export, bronze_files=files)
        for name, export, files in (
            ("files", str(tmp_path / "export"), {**BRONZE_FILES, "maxRecordsPerFile": "100"}),
            ("frame", hits, BRONZE_FILES),
            ("plain", hits, {}),
        )
    }
    assert gold["files"].count() > 1000 and bag(gold["files"]) == bag(gold["frame"]) == bag(gold["plain"])
    sizes = {
        folder: [p.stat().st_size for p in Path(folder).glob("part-*")]
        for folder in (str(tmp_path / "export"), *(layer_path(str(tmp_path / name), "place-names", "bronze") for name in ("files", "frame")))
    }
    assert all(sum(found) < text / 5 for found in sizes.values())
    assert [len(found) > 10 for found in sizes.values()] == [True, True, False]
    assert list(Path(layer_path(str(tmp_path / "plain"), "place-names", "bronze")).glob("part-*.json"))


@pytest.mark.parametrize("sf_dir", [SF_SMALL, "/root/testdata/sf0.01"])
def test_export_and_all_layers_are_smaller_than_the_text_of_the_hits(spark, tmp_path, monkeypatch, sf_dir):
    monkeypatch.setattr(records, "scratch_dir", lambda spark: str(tmp_path))
    gold = QUERIES["medallion_place_names"](spark, sf_dir)
    lines = records.hit_lines(records.place_names_hits(spark, sf_dir))
    n, text = lines.agg(F.count("*"), F.sum(F.octet_length("value") + 1)).first()
    assert gold.count() == n == records.table(spark, sf_dir, "orders").count()
    written = {
        folder: sum(p.stat().st_size for p in (tmp_path / folder).rglob("part-*"))
        for folder in ("export", *(f"place-names/{layer}" for layer in ("bronze", "silver", "gold")))
    }
    assert all(written.values()) and sum(written.values()) < text / 2
