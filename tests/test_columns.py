"""Adding, replacing, dropping, renaming and selecting columns."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hitloom.operators.columns import (
    add_columns,
    constant,
    drop_columns,
    flat,
    quoted,
    rename_columns,
    select_columns,
)


@pytest.fixture
def df(spark):
    return spark.sql("select 'x' as _id, 2.5D as `_source.duration`, 3 as `_source.n`, 1 as sort")


def test_quoted_covers_dots_and_backticks(spark):
    odd = spark.createDataFrame([(1,)], ["a`b.c"])
    assert quoted("a`b.c") == "`a``b.c`"
    assert odd.select(flat("a`b.c")).first()[0] == 1


def test_add_appends_and_replaces_in_place_under_a_dotted_name(df):
    out = add_columns(df, {"_source.duration": flat("_source.duration") * 2, "new": flat("_source.n") + 1})
    assert out.columns == ["_id", "_source.duration", "_source.n", "sort", "new"]
    assert out.first() == ("x", 5.0, 3, 1, 4)


def test_added_columns_do_not_see_each_other(df):
    out = add_columns(df, {"sort": F.col("sort") + 1, "copy": F.col("sort")})
    assert (out.first()["sort"], out.first()["copy"]) == (2, 1)


def test_drop_is_literal_and_tolerant(df, spark):
    assert drop_columns(df, "_source.n", "absent", "_source.absent").columns == ["_id", "_source.duration", "sort"]
    assert drop_columns(df).columns == df.columns
    nested = spark.sql("select named_struct('n', 1) as _source, 1 as a")
    assert drop_columns(nested, "_source.n").columns == ["_source", "a"]


def test_rename_is_literal_tolerant_and_ignores_case(df):
    out = rename_columns(df, {"_ID": "Id", "_source.n": "N", "absent": "Absent", "sort": "Sort"})
    assert out.columns == ["Id", "_source.duration", "N", "Sort"]


def test_rename_onto_a_taken_name_raises(df):
    with pytest.raises(ValueError, match="sort"):
        rename_columns(df, {"_source.n": "Sort"})
    with pytest.raises(ValueError, match="twice"):
        rename_columns(df, {"_source.n": "twice", "_id": "twice"})


def test_names_that_differ_in_case_are_fine_in_a_case_sensitive_session(df, conf):
    conf(spark__sql__caseSensitive="true")
    assert rename_columns(df, {"_source.n": "Sort"}).columns == ["_id", "_source.duration", "Sort", "sort"]


def test_select_fixes_order_and_written_case(df):
    out = select_columns(df, ["SORT", "_source.duration"])
    assert out.columns == ["SORT", "_source.duration"]


def test_select_of_a_missing_column_fails(df):
    with pytest.raises(AnalysisException):
        select_columns(df, ["sort", "missing"])


def test_constants_are_typed(df):
    out = df.select(constant("False").alias("a"), constant(None).alias("b"), constant(0, "double").alias("c"))
    assert out.dtypes == [("a", "string"), ("b", "string"), ("c", "double")]
    assert out.first() == ("False", None, 0.0)
