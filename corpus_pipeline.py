"""From raw documents to packed training sequences, in five stages.

Each stage calls one operator on all that the stage before kept; in between,
documents are written to the shared folder and read again. All stages but the
last return the columns of documents:

1. language ID drops documents whose language cannot be told: no letters, or
   words whose labels are unsure, with a mean of each word's largest posterior
   below `MIN_LANGUAGE_SURE`; a clean text in several languages stays;
2. SimHash near-dedup keeps one document of each group, the one with the
   smallest id (rows without an id come last, repeated rows in any order);
3. benchmark decontamination drops documents that contain a test item;
4. the secret scan masks secrets in texts and sets ``n_chars`` anew;
5. packing cuts and packs what is left into sequences.

Decisions that are joined back use a number that each row gets when a stage
first writes it, so null and repeated ids are rows like any other. Null texts
have no language and go; empty tables stay empty; texts of any length are taken
whole; columns that documents have beside their own are kept, whatever their
names, unless they start with ``__hitloom_``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm.common import saved, small_side, table
from hitloom.llm.decontaminate import contained_items
from hitloom.llm.labelled import fold
from hitloom.llm.langid import UNDETERMINED, train, training_texts, with_language
from hitloom.llm.packing import pack_documents
from hitloom.llm.queries import tokenizer_path
from hitloom.llm.secret_scan import mask_secrets
from hitloom.llm.simhash import near_duplicates

MIN_LANGUAGE_SURE = 0.4

_ROW = "__hitloom_row"


def _numbered(docs: DataFrame) -> DataFrame:
    return saved(docs.withColumn(_ROW, F.monotonically_increasing_id()), "numbered")


def _without(numbered: DataFrame, rows: DataFrame) -> DataFrame:
    """The numbered documents whose number is not in ``rows``, as documents again."""
    return numbered.join(small_side(saved(rows.distinct(), "dropped")), _ROW, "left_anti").drop(_ROW)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train(training_texts(docs, fold(F.col("doc_id"), 5) != 0))
    known = (F.col("__hitloom_lang_pred") != UNDETERMINED) & (F.col("__hitloom_lang_sure") >= MIN_LANGUAGE_SURE)
    return with_language(docs, model, prefix="__hitloom_lang").filter(known).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    numbered = _numbered(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(_ROW).alias("row"))
    found = near_duplicates(numbered.select(order.alias("key"), "text"), "key", "text", width=3, distance=3)
    return _without(numbered, found.filter("key <> component").select(F.col("key.row").alias(_ROW)))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    numbered = _numbered(docs)
    leaks = contained_items(numbered.select(_ROW, "text"), table(spark, sf_dir, "benchmark"), key=_ROW)
    return _without(numbered, leaks.select(_ROW))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = mask_secrets(docs)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        clean = clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), "n_chars"))
    return clean.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Stages 1 and 5 are a trained model and a tokenizer: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
