"""Flatten, array detection, outer explode and unpack."""

from collections import Counter

import pytest
from helpers import SF_SMALL, bag, brute_bag, plan
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from hitloom.operators.columns import flat
from hitloom.operators.nested import array_columns, explode_outer_all, flatten, unpack
from hitloom.workload import records


def test_flatten_reaches_every_depth_and_puts_plain_columns_first(spark):
    df = spark.createDataFrame(
        [((((1,),), "x"), 7), (((None,), "y"), 8), (None, 9)],
        "_source struct<a: struct<b: struct<c: bigint>>, _type: string>, sort bigint",
    )
    flat_df = flatten(df)
    assert flat_df.columns == ["sort", "_source.a.b.c", "_source._type"]
    assert bag(flat_df) == Counter([(7, 1, "x"), (8, None, "y"), (9, None, None)])


def test_flatten_takes_odd_field_names_literally(spark):
    df = spark.sql(
        "select named_struct('920x450', 'u', '_type', 't', 'a.b', 1, 'tick`', 2, 'white space', 3) as s"
    )
    flat_df = flatten(df)
    assert flat_df.columns == ["s.920x450", "s._type", "s.a.b", "s.tick`", "s.white space"]
    assert flat_df.first() == ("u", "t", 1, 2, 3)


def test_flatten_raises_on_names_that_meet(spark):
    nested_and_literal = spark.sql("select named_struct('b', 1) as a, 2 as `a.b`")
    with pytest.raises(ValueError, match="a.b"):
        flatten(nested_and_literal)
    with pytest.raises(ValueError, match="a.b"):
        flatten(spark.sql("select named_struct('b', 1) as a, 2 as `A.B`"))


def test_flatten_leaves_flat_frames_and_arrays_alone(spark):
    df = spark.sql("select 1 as a, array(named_struct('x', 1)) as b, map('k', 1) as m")
    assert flatten(df).schema == df.schema


def test_array_columns_come_from_the_schema(spark):
    df = spark.sql("select array(1) as a, 1 as b, cast(null as array<string>) as `c.d`")
    assert array_columns(df) == ["a", "c.d"]


def test_explode_of_siblings_is_a_cross_product(spark):
    df = spark.sql("select 1 as id, array(1, 2) as a, array('x', 'y', null) as b")
    expected = Counter((1, i, s) for i in (1, 2) for s in ("x", "y", None))
    assert bag(explode_outer_all(df, ["a", "b"])) == expected
    assert explode_outer_all(df, ["a", "b"]).columns == ["id", "a", "b"]
    assert bag(explode_outer_all(df, ["a", "b"], spread=3)) == expected


def test_explode_keeps_rows_of_empty_and_null_arrays_and_scalars(spark):
    df = spark.createDataFrame([(1, []), (2, None), (3, [5]), (4, [None])], "id int, a array<int>")
    assert bag(explode_outer_all(df, ["a", "id", "a"])) == Counter([(1, None), (2, None), (3, 5), (4, None)])


def test_unpack_example_counts(spark):
    """Two children times empty parents; three periods' examples; two mentions."""
    area = spark.sql(
        "select array(0L) as sort, named_struct('children', array('A2', 'A3'), 'parents', array()) as _source"
    )
    assert unpack(area).count() == 2
    numbers = spark.sql(
        """select array(7L) as sort, named_struct('periods', array(
            named_struct('name', 'P1', 'examples', array(named_struct('id', 1), named_struct('id', 2))),
            named_struct('name', 'P0', 'examples', array()))) as _source"""
    )
    rows = unpack(numbers)
    assert rows.columns == ["sort", "_source.periods.name", "_source.periods.examples.id"]
    assert bag(rows) == Counter([(7, "P1", 1), (7, "P1", 2), (7, "P0", None)])


def test_unpack_handles_arrays_of_arrays_and_null_structs(spark):
    df = spark.createDataFrame(
        [([[1, 2], [], None, [3]], [None, ("x",)]), (None, None)],
        "a array<array<int>>, s array<struct<v: string>>",
    )
    expected = Counter((a, s) for a in (1, 2, None, None, 3) for s in (None, "x"))
    expected[(None, None)] += 1
    assert bag(unpack(df)) == expected


def test_unpack_keeps_integers_doubles_and_infinities(spark):
    df = spark.sql("select array(named_struct('i', 9007199254740993L, 'd', double('inf'))) as a")
    assert [t for _, t in unpack(df).dtypes] == ["bigint", "double"]
    assert unpack(df).first() == (9007199254740993, float("inf"))


def test_unpack_is_idempotent_and_leaves_nothing_nested(spark):
    once = unpack(records.document_hits(spark, SF_SMALL))
    assert not [t for _, t in once.dtypes if "struct" in t or "array" in t]
    assert unpack(once).schema == once.schema


def test_drop_first_keeps_dropped_arrays_from_multiplying(spark):
    df = spark.sql(
        """select 1 as id, named_struct('tags', array(1, 2), 'p', array(
            named_struct('x', 1, 'q', array(1, 2, 3)))) as s"""
    )
    assert unpack(df).count() == 6
    assert unpack(df, drop_first=["s.tags", "absent"]).count() == 3
    assert bag(unpack(df, drop_first=["s.tags", "s.p.q"])) == Counter([(1, 1)])


def test_before_explode_sees_one_row_per_record(spark):
    df = spark.sql("select 5 as n, array(1, 2, 3) as a")
    rows = unpack(df, before_explode=lambda r: r.withColumn("m", F.col("n") * 2))
    assert bag(rows) == Counter([(5, i, 10) for i in (1, 2, 3)])


def test_row_count_is_the_product_of_lengths(spark):
    hits = records.areas_hits(spark, SF_SMALL)
    lengths = [F.greatest(F.lit(1), F.coalesce(F.size(c), F.lit(0))) for c in
               ("_ignored", "sort", "_source.hierarchy_children", "_source.hierarchy_parents")]
    expected = hits.select(F.sum(lengths[0] * lengths[1] * lengths[2] * lengths[3])).first()[0]
    assert unpack(hits).count() == expected


def test_unpack_is_one_stage_without_shuffle_or_python(spark):
    text = plan(unpack(records.document_hits(spark, SF_SMALL)))
    assert "Exchange" not in text and "Python" not in text
    assert text.count("Generate explode") == 3


def test_fields_nobody_selects_are_not_scanned(spark, tmp_path):
    records.areas_hits(spark, SF_SMALL).write.parquet(str(tmp_path / "hits"))
    hits = spark.read.parquet(str(tmp_path / "hits"))
    scan = plan(flatten(hits).select("_id", flat("_source.name"))).split("ReadSchema:")[1]
    assert "name:string" in scan and "geometry" not in scan and "_index" not in scan


def test_spread_gives_one_hot_record_to_many_tasks(spark):
    df = spark.sql("select 1 as id, sequence(1, 400) as a, sequence(1, 300) as b")
    per_task = (
        unpack(df, spread=8).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    )
    assert sum(r["count"] for r in per_task) == 400 * 300
    assert len(per_task) == 8 and max(r["count"] for r in per_task) < 400 * 300 / 4


def _schemas():
    scalar = st.sampled_from([LongType(), StringType()])

    def struct_of(children):
        return st.lists(children, min_size=1, max_size=3).map(
            lambda types: StructType([StructField(f"f{i}", t) for i, t in enumerate(types)])
        )

    nested = st.recursive(scalar, lambda c: st.one_of(struct_of(c), c.map(ArrayType)), max_leaves=5)
    return struct_of(nested)


def _values(dtype):
    if isinstance(dtype, StructType):
        values = st.fixed_dictionaries({f.name: _values(f.dataType) for f in dtype.fields})
    elif isinstance(dtype, ArrayType):
        values = st.lists(_values(dtype.elementType), max_size=3)
    elif isinstance(dtype, LongType):
        values = st.integers(-3, 3)
    else:
        values = st.sampled_from(["", "a", "b"])
    return st.one_of(st.none(), values)


@st.composite
def _record_sets(draw):
    schema = draw(_schemas())
    record = st.fixed_dictionaries({f.name: _values(f.dataType) for f in schema.fields})
    return schema, draw(st.lists(record, min_size=1, max_size=6))


@settings(max_examples=25, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(_record_sets())
def test_unpack_agrees_with_its_definition(spark, case):
    schema, rows = case
    result = unpack(spark.createDataFrame(rows, schema))
    assert bag(result) == brute_bag(rows, schema, result.columns)


def test_explode_names_follow_the_session_s_case_rule(spark, conf):
    df = spark.createDataFrame([(1, [1, 2])], "id int, flag array<int>")
    assert explode_outer_all(df, ["Flag"]).count() == 2
    with pytest.raises(ValueError, match="flags"):
        explode_outer_all(df, ["flags"])
    conf(spark__sql__caseSensitive="true")
    with pytest.raises(ValueError, match="Flag"):
        explode_outer_all(df, ["Flag"])


def test_spread_does_not_change_a_hot_record_s_rows(spark):
    from hitloom.workload.records import hot_record_hits

    hits = hot_record_hits(spark, SF_SMALL)
    assert bag(unpack(hits, spread=5)) == bag(unpack(hits))
