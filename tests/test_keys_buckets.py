"""Bucketed lookups and the audit of joined keys."""

import uuid
from collections import Counter

import pytest
from helpers import bag, plan
from pyspark.sql import functions as F

from hitloom.functions.scalars import joined_key
from hitloom.operators.keys import key_collisions, key_sketches, merged_sketches, sketched_counts
from hitloom.operators.lookup import lookup_left_join
from hitloom.sources.buckets import bucketed_left_join, read_bucketed, write_bucketed


@pytest.fixture
def names():
    return [f"hitloom_test_{uuid.uuid4().hex}" for _ in range(3)]


def tables(spark, tmp_path, names):
    left = spark.range(2000).selectExpr("id", "if(id % 4 = 0, null, if(id % 4 = 1, 7, id)) as k")
    lookup = spark.range(1000).selectExpr("id as Id", "id * 2 as Sort", "'x' as Unused").unionByName(
        spark.createDataFrame([(7, -1, "y"), (None, -2, "z")], "Id long, Sort long, Unused string")
    )
    return (
        left,
        lookup,
        write_bucketed(left, names[0], str(tmp_path / "left"), "k", 8),
        write_bucketed(lookup, names[1], str(tmp_path / "lookup"), "Id", 8),
    )


@pytest.mark.parametrize("hot", [(), (7,), (7, 11)])
def test_rows_are_those_of_the_shuffled_join(spark, tmp_path, names, hot):
    left, lookup, a, b = tables(spark, tmp_path, names)
    expected = lookup_left_join(left, lookup, "k", "Id", {"Sort": "AreaId"})
    assert bag(bucketed_left_join(a, b, "k", "Id", {"Sort": "AreaId"}, hot)) == bag(expected)


def test_nothing_is_shuffled(spark, tmp_path, names, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    _, _, a, b = tables(spark, tmp_path, names)
    text = plan(bucketed_left_join(a, b, "k", "Id", {"Sort": "AreaId"}))
    assert "SortMergeJoin" in text and "Exchange" not in text and "Unused" not in text
    again = read_bucketed(spark, names[2], str(tmp_path / "lookup"), "Id", 8)  # as another session would
    assert "Exchange" not in plan(bucketed_left_join(a, again, "k", "Id", {"Sort": "AreaId"}))
    assert len(list((tmp_path / "lookup").glob("*.parquet"))) <= 8


def test_only_the_other_side_is_shuffled(spark, tmp_path, names, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    left, _, _, b = tables(spark, tmp_path, names)
    text = plan(bucketed_left_join(left, b, "k", "Id", {"Sort": "AreaId"}))
    assert text.count("Exchange hashpartitioning") == 1


def test_a_taken_name_that_exists_raises(spark, tmp_path, names):
    _, _, a, b = tables(spark, tmp_path, names)
    with pytest.raises(ValueError, match="clash"):
        bucketed_left_join(a, b, "k", "Id", {"Sort": "ID"})


def keyed(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, n int")
    return df.withColumn("key", joined_key(F.col("a"), F.col("b")))


ROWS = [("1", "23", 0), ("12", "3", 1), ("1", "23", 2), ("4", "5", 3), (None, "x", 4), ("", "ab", 5), ("ab", "", 6), ("a", "b", 7)]


@pytest.mark.parametrize("sketched", [False, True])
def test_collisions(spark, sketched):
    df = keyed(spark, ROWS + [(str(k), "-", 9) for k in range(500)])
    sketches = key_sketches(df, "key", ["a", "b"], 16) if sketched else None
    found = key_collisions(df, "key", ["a", "b"], sketches)
    assert found.columns == ["key", "a", "b"]
    assert bag(found) == Counter([("123", "1", "23"), ("123", "12", "3"), ("ab", "", "ab"), ("ab", "ab", ""), ("ab", "a", "b")])


def test_sketches_merge_over_layers(spark):
    first, second = keyed(spark, ROWS[:1]), keyed(spark, ROWS[1:4])
    apart = [key_sketches(df, "key", ["a", "b"], 4) for df in (first, second)]
    assert [sketched_counts(s).first()[2] for s in apart] == [0, 1]
    assert sketched_counts(key_sketches(keyed(spark, ROWS[2:4]), "key", ["a", "b"], 4)).first() == (2, 2, 0)
    both = merged_sketches(*apart)
    assert sketched_counts(both).first() == (2, 3, 1)
    assert bag(key_collisions(first.unionByName(second), "key", ["a", "b"], both)) == Counter([("123", "1", "23"), ("123", "12", "3")])


def test_no_collision_reads_no_rows_twice(spark):
    df = keyed(spark, [(str(k), "x", k) for k in range(2000)])
    sketches = key_sketches(df, "key", ["a", "b"])
    assert sketched_counts(sketches).first()[2] == 0
    assert key_collisions(df, "key", ["a", "b"], sketches).count() == 0
    assert key_collisions(df.limit(0), "key", ["a", "b"], key_sketches(df.limit(0), "key", ["a", "b"])).count() == 0
