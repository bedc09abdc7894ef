"""Each topic on hand-made hits: exact columns and rows."""

import hashlib
import json
from collections import Counter
from dataclasses import replace

import pytest
from helpers import SF_SMALL, bag, plan
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hitloom.operators.columns import select_columns
from hitloom.plans import contract
from hitloom.plans.medallion import curate
from hitloom.plans.topics import TOPICS
from hitloom.sources.hits import read_hits
from hitloom.workload import records

BUILDERS = {
    "areas": records.areas_hits,
    "area-by-numbers": records.area_by_numbers_hits,
    "grant-aided-places": records.grant_aided_places_hits,
    "historic-places": records.historic_places_hits,
    "images": records.images_hits,
    "place-names": records.place_names_hits,
    "stories": records.stories_hits,
}


def hit(hit_id, index, sort, source, **extra):
    return {"_id": hit_id, "_index": index, "_score": None, "sort": [sort], "_source": source, **extra}


AREA = hit(
    "A1",
    "areas",
    0,
    {
        "name": "North Vale", "kind": "county", "active": True, "hierarchy_level": 2,
        "hierarchy_level_name": "County", "description": "d", "header_image_id": "i1",
        "geometry": "POINT (-1.5 52.25)", "hierarchy_children": ["A2", "A3"], "hierarchy_parents": [],
        "in_scope": True, "scope_note": None, "view_more_url": "http://x.example/a1",
    },
)
EXAMPLE = {"nhle_id": "10", "name": "n", "image_id": "i", "priority": 1, "summary_text": "t", "url": "u"}
NUMBERS = hit(
    "N1",
    "area-by-numbers",
    7,
    {
        "area_id": "A1",
        "periods": [
            {"name": "P1", "date_range": "1066 to 1485", "sort": 1, "description": "d", "description_source": "s",
             "description_source_url": "u", "examples": [EXAMPLE, {**EXAMPLE, "nhle_id": "11"}]},
            {"name": "P0", "date_range": "Before 1066", "sort": 0, "description": "d", "description_source": "s",
             "description_source_url": "u", "examples": []},
        ],
    },
)
STORY = hit(
    "S1",
    "stories",
    3,
    {
        "_type": "video", "title": "t", "description": "d", "url": "u", "image_id": "i", "featured": False,
        "duration": 90061.5,
        "mentions": [
            {"_type": "place", "name": "n", "area_id": "A1", "url": "u", "anchor": "#a"},
            {"_type": "place", "name": "m", "area_id": "A9", "url": "v", "anchor": None},
        ],
    },
)


@pytest.fixture
def read(spark, tmp_path):
    def run(*hits):
        path = tmp_path / "hits.json"
        path.write_text("\n".join(json.dumps(h) for h in hits))
        return read_hits(spark, str(path))

    return run


def test_areas(read):
    out = curate(read(AREA), TOPICS["areas"])
    assert set(out.columns) == set(contract.AREAS_RENAME.values())
    values = {r["Id"]: r.asDict() for r in out.collect()}["A1"]
    assert out.count() == 2
    assert (values["Title"], values["Sort"], values["HierarchyLevel"], values["Active"]) == ("North Vale", 0, 2, True)


def test_areas_without_the_children_that_are_dropped(read):
    children = ("_source.hierarchy_children", "_source.hierarchy_parents")
    assert curate(read(AREA), TOPICS["areas"], drop_first=children).count() == 1


def test_area_by_numbers(read, spark):
    areas = spark.createDataFrame([("A1", 0), ("A2", 1)], "Id string, Sort bigint")
    out = curate(read(NUMBERS), TOPICS["area-by-numbers"], {"areas": areas})
    assert out.columns == [
        *contract.AREA_BY_NUMBERS_RENAME.values(), "date_range_from", "date_range_to", "AreaId",
    ]
    picked = out.select("AreaName", "PeriodName", "PeriodSort", "nhleId", "date_range_from", "date_range_to", "AreaId")
    assert bag(picked) == Counter(
        [
            ("A1", "P1", 1, "10", "1066", "1485", 0),
            ("A1", "P1", 1, "11", "1066", "1485", 0),
            ("A1", "P0", 0, None, None, "Before 1066", 0),
        ]
    )


def test_a_lookup_key_inside_an_array_waits_for_the_explode(read, spark):
    areas = spark.createDataFrame([("A1", 5), ("A2", 6)], "Id string, Sort bigint")
    source = {**NUMBERS["_source"], "area_id": ["A1", "A2", "A3"]}
    out = curate(read({**NUMBERS, "_source": source}), TOPICS["area-by-numbers"], {"areas": areas})
    assert bag(out.groupBy("AreaName", "AreaId").count()) == Counter([("A1", 5, 3), ("A2", 6, 3), ("A3", None, 3)])


@pytest.mark.parametrize("changes", [{"salts": 4}, {"fold_copies": False}, {"salts": 4, "fold_copies": False}])
def test_salts_and_folding_do_not_change_the_rows(spark, conf, changes):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    lookups = {"areas": curate(records.areas_hits(spark, SF_SMALL), TOPICS["areas"])}
    spec = TOPICS["area-by-numbers"]
    hits = records.area_by_numbers_hits(spark, SF_SMALL)
    changed = replace(spec, lookups=tuple(replace(one, **changes) for one in spec.lookups))
    assert bag(curate(hits, changed, lookups)) == bag(curate(hits, spec, lookups))


def test_the_lookup_join_runs_before_the_explodes(spark):
    areas = curate(records.areas_hits(spark, SF_SMALL), TOPICS["areas"])
    text = plan(curate(records.area_by_numbers_hits(spark, SF_SMALL), TOPICS["area-by-numbers"], {"areas": areas}))
    assert text.index("Generate explode(_source.periods.examples") < text.index("Join")


def test_grant_aided_places(read):
    source = {
        "status": "s", "url": "u", "nhle_id": 1000042, "name": "n", "is_listed": True, "map_view_url": "m",
        "priority": 1, "area_id": ["A1", "A2"], "description": "d", "image_id": "i", "geometry": "g", "extra": "kept",
    }
    out = curate(
        read(
            hit("G1", "g", 1, source, _ignored=["x"]),
            hit("G2", "g", 2, {**source, "nhle_id": None, "area_id": []}, _ignored=None),
        ),
        TOPICS["grant-aided-places"],
    )
    assert set(out.columns) == {
        *contract.GRANT_AIDED_PLACES_RENAME.values(), "ExternalLinkUrl", "isHidden", "ConcatenatedId", "_source.extra",
    }
    link = contract.MAP_SEARCH_URL + "1000042"
    picked = out.select("Id", "NHLE_UID", "AreaId", "ExternalLinkUrl", "isHidden", "ConcatenatedId", "`_source.extra`")
    assert dict(picked.dtypes)["NHLE_UID"] == "int"
    assert bag(picked) == Counter(
        [
            ("G1", 1000042, "A1", link, "False", "G1A1", "kept"),
            ("G1", 1000042, "A2", link, "False", "G1A2", "kept"),
            ("G2", None, None, None, "False", None, "kept"),
        ]
    )


def test_a_float_id_leaves_no_fraction_in_the_link(read):
    source = {"nhle_id": 1000042.0, "area_id": "A1"}
    out = curate(read(hit("G1", "g", 1, source)), TOPICS["grant-aided-places"])
    assert out.select("ExternalLinkUrl", "ConcatenatedId").first() == (contract.MAP_SEARCH_URL + "1000042", "G1A1")


def test_historic_places_use_the_id_as_text_before_it_becomes_a_number(read):
    source = {
        "name": "n", "heritage_category": "c", "grade": "II", "summary_text": "t", "image_id": "i", "locality": "l",
        "priority": 1, "area_id": ["A1"], "identifying_location": "x", "geometry": "g", "display_in_highlights": True,
    }
    out = curate(read(hit("0012", "h", 1, source), hit("x1", "h", 2, source)), TOPICS["historic-places"])
    assert set(out.columns) == {*contract.HISTORIC_PLACES_RENAME.values(), "ExternalLinkUrl", "ConcatenatedId"}
    assert dict(out.dtypes)["Id"] == "int"
    assert bag(out.select("Id", "ExternalLinkUrl", "ConcatenatedId")) == Counter(
        [(12, contract.LIST_ENTRY_URL + "0012", "0012A1"), (None, contract.LIST_ENTRY_URL + "x1", "x1A1")]
    )


def test_images(read):
    sizes = {size: f"u/{size}" for size in ("920x450", "759x569", "373x240", "868x560", "375x250", "700x400", "868x450")}
    source = {
        "created_date": "2024", "description": "d", "url": "u", "source": "s", "copyright_statement": "c",
        "find_out_more_url": "f", "sized_url": sizes, "image_id": "I1",
    }
    out = curate(read(hit("I1", "i", 1, source), hit("I2", "i", 2, {**source, "sized_url": None})), TOPICS["images"])
    assert set(out.columns) == set(contract.IMAGES_RENAME.values())
    assert bag(out.select("id", "sort", "sized_url_920x450")) == Counter([("I1", 1, "u/920x450"), ("I2", 2, None)])


def test_place_names(read):
    source = {"_type": "t", "geometry": "POINT (-1.5 52.25)", "name": "n", "place_id": "p", "area_id": "A1"}
    out = curate(read(hit("P1", "p", 1, source)), TOPICS["place-names"])
    assert out.select("Id", "Name", "Type", "longitude", "latitude", "hashkey").first() == (
        "P1", "n", "t", "-1.5", "52.25", hashlib.sha256(b"P1").hexdigest(),
    )
    assert "_source.area_id" not in out.columns


def test_place_names_contract_is_complete(spark):
    out = curate(records.place_names_hits(spark, SF_SMALL), TOPICS["place-names"])
    assert set(out.columns) == {*contract.PLACE_NAMES_RENAME.values(), "longitude", "latitude", "hashkey"}


def test_stories(read):
    out = curate(read(STORY), TOPICS["stories"])
    assert set(out.columns) == {
        *contract.STORIES_RENAME.values(),
        "ExternalAssetEmbed", "IsHidden", "DurationConverted", "URLAnchorCombined", "CreatedOn",
    }
    picked = out.select(
        "Id", "MentionedLocationText", "AreaId", "MediaDuration", "DurationConverted",
        "ExternalAssetEmbed", "IsHidden", "URLAnchorCombined", F.col("CreatedOn").isNotNull(),
    )
    assert bag(picked) == Counter(
        [
            ("S1", "n", "A1", 90062, "01:01:02", "filler", "False", "S1#a", True),
            ("S1", "m", "A9", 90062, "01:01:02", "filler", "False", None, True),
        ]
    )


def test_derived_columns_come_last_in_the_order_they_are_named(read):
    out = curate(read(STORY), TOPICS["stories"])
    assert out.columns == [
        "Id", "Index", "Score", "Sort", "Type", "Description", "Featured", "ThumbnailImageId", "Title",
        "ExternalAssetSourceUrl", "AreaId", "MentionedLocationText", "ExternalLinkUrl", "MediaDuration",
        "ExternalAssetEmbed", "IsHidden", "DurationConverted", "URLAnchorCombined", "CreatedOn",
    ]


def test_a_record_step_whose_input_is_in_an_array_waits_for_the_explode(read):
    source = {**STORY["_source"], "duration": [1.5, 2.0]}
    out = curate(read({**STORY, "_source": source}), TOPICS["stories"])
    assert bag(out.groupBy("MediaDuration").count()) == Counter([(2, 4)])


def test_durations_written_as_bare_infinity(read):
    hits = [hit(f"S{i}", "s", i, {**STORY["_source"], "duration": d}) for i, d in
            enumerate((float("inf"), float("-inf"), float("nan"), None, 1.0))]
    out = curate(read(*hits), TOPICS["stories"]).select("Id", "MediaDuration").distinct()
    assert bag(out) == Counter([("S0", 0), ("S1", 0), ("S2", None), ("S3", None), ("S4", 1)])


def test_a_field_a_step_needs_must_exist(read):
    with pytest.raises(AnalysisException):
        curate(read(hit("G1", "g", 1, {"name": "n"})), TOPICS["grant-aided-places"])


def test_a_missing_lookup_table_is_an_error(read):
    with pytest.raises(KeyError):
        curate(read(NUMBERS), TOPICS["area-by-numbers"])


@pytest.mark.parametrize("name", sorted(BUILDERS))
def test_topics_run_without_python_and_shuffle_only_to_join(spark, name):
    lookups = {"areas": curate(records.areas_hits(spark, SF_SMALL), TOPICS["areas"])}
    text = plan(curate(BUILDERS[name](spark, SF_SMALL), TOPICS[name], lookups))
    assert "Python" not in text
    # The lookup is folded, then broadcast.
    assert text.count("Exchange") == (2 if TOPICS[name].lookups else 0)


@pytest.mark.parametrize("name", ["area-by-numbers", "stories"])
def test_spread_changes_nothing_but_the_distribution(spark, name):
    lookups = {"areas": curate(records.areas_hits(spark, SF_SMALL), TOPICS["areas"])}
    hits = BUILDERS[name](spark, SF_SMALL)
    plain = curate(hits, TOPICS[name], lookups).drop("CreatedOn")
    spread = curate(hits, TOPICS[name], lookups, spread=3).drop("CreatedOn")
    assert spread.schema == plain.schema
    assert bag(select_columns(spread, plain.columns)) == bag(plain)
