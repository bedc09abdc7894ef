"""Every registered query against its SQL, and the driver contract."""

import shutil
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from helpers import SF_SMALL, plan
from oracle_check import connect, differences

import __spark_entry__ as contract
from hitloom.workload import records
from hitloom.workload.oracle import ORACLE_SQL
from hitloom.workload.queries import QUERIES

WRITES_TABLES = {
    "bronze_roundtrip",
    "compact_documents",
    "conflicting_hits",
    "gold_aggregate",
    "gold_from_hits",
    "indented_documents",
    "lookup_bucketed",
    "map_entries",
    "map_pivot",
    "replaced_layer",
    "run_report",
    "mixed_fields",
    "multi_line_documents",
    "rejected_hits",
    "silver_gold_roundtrip",
    *(name for name in QUERIES if name.startswith("medallion_")),
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())


def test_contract_works_without_the_text_operators(tmp_path):
    """Only the guard in the entry module knows of them."""
    root = Path(contract.__file__).resolve().parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "hitloom", tmp_path / "hitloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as m; print(len(m.queries()), len(m.oracle_sql()))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert ran.returncode == 0, ran.stderr
    assert ran.stdout.split() == [str(len(QUERIES)), str(len(ORACLE_SQL))]


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert differences(df, duck, ORACLE_SQL[name]) == []
    # No query leaves the JVM or multiplies tables.
    text = plan(df)
    assert not [word for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop") if word in text]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_TABLES))
def test_query_equals_its_sql_without_ansi_in_another_zone(spark, duck, conf, name):
    conf(spark__sql__ansi__enabled="false", spark__sql__session__timeZone="Asia/Kolkata")
    assert differences(QUERIES[name](spark, SF_SMALL), duck, ORACLE_SQL[name]) == []


def test_scratch_folders_are_new_and_shared(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = records.scratch_dir(spark), records.scratch_dir(spark)
    assert first != second and first.startswith(shared) and second.startswith(shared)


@pytest.mark.parametrize(
    ("master", "warehouse"), [("local[4]", "file:/warehouse"), ("local", "file:/warehouse"), ("spark://h:1", "hdfs://n/warehouse")]
)
def test_scratch_is_in_the_warehouse_where_no_shared_folder_is_named(master, warehouse):
    settings = {"spark.sql.warehouse.dir": warehouse, "spark.master": master}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))
    assert records.scratch_dir(session).startswith(f"{warehouse}/_scratch/hitloom-")


@pytest.mark.parametrize("warehouse", ["file:/warehouse", "/warehouse"])
def test_a_local_warehouse_is_no_shared_folder_of_a_cluster(warehouse):
    settings = {"spark.sql.warehouse.dir": warehouse, "spark.master": "spark://h:1"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        records.scratch_dir(session)


def test_documents_are_bounded_in_bytes(spark, tmp_path):
    lines = spark.range(500).selectExpr("""concat('{"_id":"', id, '","t":"', repeat('x', 100), '"}') AS value""")
    records.write_documents(lines, str(tmp_path / "d"), document_bytes=5000)
    sizes = [p.stat().st_size for p in (tmp_path / "d").glob("part-*")]
    assert len(sizes) > 10 and max(sizes) < 6000
