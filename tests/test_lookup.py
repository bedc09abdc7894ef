"""Left lookup join."""

from collections import Counter

import pytest
from helpers import bag, plan
from pyspark.sql import functions as F

from hitloom.operators.lookup import lookup_left_join


@pytest.fixture
def areas(spark):
    return spark.createDataFrame(
        [("A1", 10, "x"), ("A2", 20, "y"), ("A2", 21, "z"), (None, 99, "n")], "Id string, Sort bigint, Other string"
    )


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "A1"), (2, "A2"), (3, "A9"), (4, None)], "n int, `s.area` string")


EXPECTED = Counter([(1, "A1", 10), (2, "A2", 20), (2, "A2", 21), (3, "A9", None), (4, None, None)])


@pytest.mark.parametrize("salts", [1, 5])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_unmatched_null_and_repeated_keys(rows, areas, conf, salts, broadcast):
    conf(spark__sql__autoBroadcastJoinThreshold=broadcast)
    out = lookup_left_join(rows, areas, "s.area", "Id", {"sort": "AreaId"}, salts=salts)
    assert out.columns == ["n", "s.area", "AreaId"]
    assert bag(out) == EXPECTED


@pytest.mark.parametrize("salts", [1, 3])
def test_folded_copies_give_the_same_rows(spark, rows, areas, salts):
    repeated = areas.unionAll(areas.filter("Id = 'A1'")).unionAll(areas.filter("Id = 'A1'"))
    take = {"Sort": "Area.Id", "Other": "Other"}
    plain = lookup_left_join(rows, repeated, "s.area", "Id", take)
    folded = lookup_left_join(rows, repeated, "s.area", "Id", take, salts=salts, fold_copies=True)
    assert folded.columns == plain.columns
    assert bag(folded) == bag(plain) and plain.count() == 7


def test_a_lookup_of_copies_only_is_shuffled_once_per_task(spark):
    lookup = spark.range(0, 200_000, 1, 4).selectExpr("'A' as Id", "1 as Sort")
    left = spark.createDataFrame([(1, "A"), (2, "B")], "n int, k string")
    out = lookup_left_join(left, lookup, "k", "Id", {"Sort": "Sort"}, fold_copies=True)
    assert bag(out.groupBy("n", "Sort").count()) == Counter([(1, 1, 200_000), (2, None, 1)])
    text = plan(lookup_left_join(left, lookup, "k", "Id", {"Sort": "Sort"}, fold_copies=True))
    assert "partial_count" in text


def test_lookup_made_from_the_same_table(areas):
    out = lookup_left_join(areas, areas, "Id", "Id", {"Other": "Twin"})
    assert out.count() == 1 + 4 + 1


def test_the_lookup_key_can_be_taken_too(rows, areas):
    out = lookup_left_join(rows, areas, "s.area", "Id", {"Id": "Matched"}).select("n", "Matched").distinct()
    assert bag(out) == Counter([(1, "A1"), (2, "A2"), (3, None), (4, None)])


def test_taken_name_that_exists_raises(rows, areas):
    with pytest.raises(ValueError, match="n"):
        lookup_left_join(rows, areas, "s.area", "Id", {"Sort": "N"})


def test_small_lookup_is_broadcast_and_large_one_is_not(spark, tmp_path, conf):
    spark.range(1000).selectExpr("id as Id", "id as Sort", "id as Unused").write.parquet(str(tmp_path / "gold"))
    lookup = spark.read.parquet(str(tmp_path / "gold"))
    left = spark.range(100).withColumnRenamed("id", "k")
    text = plan(lookup_left_join(left, lookup, "k", "Id", {"Sort": "AreaId"}))
    assert "BroadcastHashJoin" in text and "Unused" not in text
    conf(spark__sql__autoBroadcastJoinThreshold="1KB")
    assert "SortMergeJoin" in plan(lookup_left_join(left, lookup, "k", "Id", {"Sort": "AreaId"}))


def test_adaptive_execution_splits_a_hot_key(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="8",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    left = spark.range(0, 60_000, 1, 8).selectExpr("id", "if(id % 3 = 0, null, if(id % 3 = 1, 7, id)) as k")
    lookup = spark.range(0, 1000).selectExpr("id as Id", "id * 2 as Sort")
    out = lookup_left_join(left, lookup, "k", "Id", {"Sort": "AreaId"})
    counts = bag(out.groupBy((F.col("AreaId") == 14).alias("hot")).count())
    assert counts[(True, 20_000)] == 1
    out.collect()
    assert "skew=true" in plan(out)


def test_salts_spread_a_hot_key_without_adaptive_execution(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    left = spark.range(0, 8000).selectExpr("id", "7 + pmod(id, 1) as k")
    lookup = spark.range(0, 10).selectExpr("id as Id", "id * 2 as Sort")

    def largest_task(salts):
        out = lookup_left_join(left, lookup, "k", "Id", {"Sort": "AreaId"}, salts=salts)
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 8000
        return max(r["count"] for r in sizes)

    assert largest_task(1) == 8000
    assert largest_task(16) < 8000


def test_null_keys_are_dealt_out_without_copying_the_lookup(spark, conf):
    conf(
        spark__sql__adaptive__enabled="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="8",
    )
    left = spark.range(0, 8000).selectExpr("id", "if(id % 2 = 0, null, id % 10) as k")
    lookup = spark.range(0, 10).selectExpr("id as Id", "id * 2 as Sort")
    out = lookup_left_join(left, lookup, "k", "Id", {"Sort": "AreaId"})
    nulls = out.filter("k is null").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in nulls) == 4000 and max(r["count"] for r in nulls) < 1000
    assert "Generate" not in plan(out)


def test_only_hot_keys_of_the_lookup_are_repeated(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    left = spark.range(0, 8000).selectExpr("id", "if(id % 2 = 0, 7, id % 1000) as k")
    lookup = spark.range(0, 1000).selectExpr("id as Id", "id * 2 as Sort")
    for hot_keys in (None, [7], []):
        out = lookup_left_join(left, lookup, "k", "Id", {"Sort": "AreaId"}, salts=8, hot_keys=hot_keys)
        assert out.filter("AreaId = k * 2").count() == 8000
        sizes = [r["count"] for r in out.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()]
        assert (len(sizes) > 1) == (hot_keys != [])


def test_many_copies_are_repeated_in_parts(spark, monkeypatch):
    monkeypatch.setattr("hitloom.operators.lookup._BLOCK_ROWS", 3)
    lookup = spark.createDataFrame([("A", 1)] * 10 + [("B", 2)] * 3 + [("C", 3)], "Id string, Sort int")
    left = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, "D")], "n int, k string")
    out = lookup_left_join(left, lookup, "k", "Id", {"Sort": "Sort"}, fold_copies=True)
    assert bag(out.select("n")) == Counter({(1,): 10, (2,): 3, (3,): 1, (4,): 1})
