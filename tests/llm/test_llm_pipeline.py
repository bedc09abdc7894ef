from llm_cases import TEXTS
from oracle_check import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from hitloom.llm.queries import ORACLE_SQL, QUERIES

SF_TINY, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_every_operator_has_one_query():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE_SQL) <= set(contract.oracle_sql())


def test_queries_equal_their_sql(spark):
    con = connect(SF_TINY)
    for name, sql in ORACLE_SQL.items():
        assert differences(QUERIES[name](spark, SF_TINY), con, sql) == [], name


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def unusual(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS)


def test_stages_take_unusual_and_empty_documents(spark):
    for name, run in corpus_pipeline.STAGES:
        for rows in (TEXTS, []):
            docs = unusual(spark, rows)
            made = run(spark, docs, SF_TINY)
            assert made.count() >= 0
            if name != corpus_pipeline.STAGES[-1][0]:
                assert made.dtypes == docs.dtypes, name


def test_stages_keep_extra_columns_with_clashing_names(spark):
    extra = {"_lang_pred": "a", "fp": "b", "component": "c", "key": "d", "h": "e", "blob": "f", "item_id": "g", "w": "h", "tie": "i"}
    docs = unusual(spark, [(1, "one two three"), (2, "the of and to in"), (None, "x y z")])
    for name, value in extra.items():
        docs = docs.withColumn(name, F.lit(value))
    for name, run in corpus_pipeline.STAGES[:-1]:
        made = run(spark, docs, SF_TINY)
        assert made.columns == docs.columns, name
        assert all(r[c] == v for r in made.collect() for c, v in extra.items()), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_TINY).select("doc_id").distinct().count() == 3


def test_one_document_of_each_group_stays(spark):
    same = "one two three four five six"
    rows = [(5, same), (3, same), (3, same), (None, same), (9, same.upper()), (7, "something else here now"), (None, None), (1, "")]
    kept = stage("near_dedup")(spark, unusual(spark, rows), SF_TINY)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, ""), (3, same), (7, "something else here now")]


def test_language_stage_drops_what_has_no_letters(spark):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    odd = spark.createDataFrame([(-1, "12 34 !!", "en", "s", 8), (-2, None, "en", "s", 0)], docs.schema)
    kept = stage("language_id")(spark, docs.unionByName(odd), SF_TINY)
    assert kept.filter("doc_id < 0").count() == 0
    assert kept.count() == docs.count()


def test_language_stage_keeps_texts_in_several_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    parts = {r.lang: r.text for r in docs.filter("length(text) between 800 and 2000").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    assert len(parts) >= 3
    mixed = spark.createDataFrame([(-1, " ".join(t[:800] for t in parts.values()), "en", "s", 1)], docs.schema)
    kept = stage("language_id")(spark, docs.unionByName(mixed), SF)
    assert kept.filter("doc_id = -1").count() == 1


def test_decontamination_stage_drops_rows_without_an_id_too(spark):
    item = spark.read.parquet(f"{SF_TINY}/benchmark.parquet").first().text
    kept = stage("decontaminate")(spark, unusual(spark, [(1, "x " + item), (None, item), (2, "clean"), (None, "fine")]), SF_TINY)
    assert sorted(r.text for r in kept.collect()) == ["clean", "fine"]


def test_secret_stage_masks_and_counts_anew(spark):
    made = stage("secret_scan")(spark, unusual(spark, [(1, "a password=abcdefgh b"), (2, "plain"), (3, None)]), SF_TINY)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in made.collect() if r.text) == [(1, "a [SECRET] b", 12), (2, "plain", 5)]


def test_pipeline_packs_what_its_stages_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = corpus_pipeline.run(spark, SF).cache()
    kept = packed.select("doc_id").distinct()
    assert 0.8 * docs.count() < kept.count() < docs.count()
    leaks = QUERIES["op3_decontaminate"](spark, SF).select("doc_id").distinct()
    groups = QUERIES["op2_simhash"](spark, SF).filter("doc_id <> component_id")
    assert kept.join(leaks, "doc_id").count() == 0
    assert kept.join(groups, "doc_id").count() == 0
    gone = docs.join(kept, "doc_id", "left_anti").join(leaks, "doc_id", "left_anti").join(groups, "doc_id", "left_anti")
    assert gone.count() == 0
    whole = packed.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n"))
    assert whole.filter("n <> doc_tokens").count() == 0
