"""Findings of the secret scan for every version that paths ever had.

Beside the ledger of blobs lies a history: a row for each blob that came to a
path or left it in some version. Recording a version compares its paths with
the state before and appends only what changed, in one commit; its texts are
scanned as any, so a blob that some path has had before is not scanned again.
Findings are joined back to all paths and versions, also to those whose secret
has since been taken out: it is still in the history, and to be revoked.

All is DataFrame functions. Defined cases: rows without a path have no history
(their texts are scanned all the same); a path that is repeated within a version
has several blobs at a time; a version without rows empties all paths; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitloom.llm.common import saved, whole_text
from hitloom.llm.secret_scan import RULES, SecretRule, blob_findings, scan

HISTORY_SCHEMA = "path string, blob string, version long, there boolean"


def read_history(spark: SparkSession, history: str) -> DataFrame:
    """The changes recorded so far; none before the first version."""
    try:
        return spark.read.schema(HISTORY_SCHEMA).parquet(history)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], HISTORY_SCHEMA)


def record_version(
    docs: DataFrame,
    version: int,
    history: str,
    ledger: str,
    path: str = "doc_id",
    text: str = "text",
    rules: Sequence[SecretRule] = RULES,
) -> None:
    """Scan a version's texts and record which blob each path has in it.

    ``history`` and ``ledger`` are folders that all executors share. Versions
    are recorded in rising order; one that is not above the last raises ``ValueError``.
    """
    spark = docs.sparkSession
    before = read_history(spark, history)
    last = before.agg(F.max("version")).first()[0]
    if last is not None and version <= last:
        raise ValueError(f"version {version} comes after {last} has been recorded")
    scan(docs, ledger, text, rules)
    now = docs.filter(F.col(path).isNotNull()).select(
        F.col(path).cast("string").alias("path"), F.sha2(whole_text(text), 256).alias("blob")
    )
    state = before.groupBy("path", "blob").agg(F.max_by("there", "version").alias("there")).filter("there").select("path", "blob")
    # One shuffle on (path, blob) for both sides; what both have did not change.
    both = now.distinct().withColumn("now", F.lit(1)).unionByName(state.withColumn("now", F.lit(-1)))
    changed = both.groupBy("path", "blob").agg(F.sum("now").alias("now")).filter("now <> 0")
    rows = changed.select("path", "blob", F.lit(version).cast("long").alias("version"), (F.col("now") > 0).alias("there"))
    saved(rows, "changes").write.mode("append").parquet(history)


def history_findings(spark: SparkSession, history: str, ledger: str, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """(path, blob, since, until, spans) for every stay of a blob with findings at a path; ``until`` is null if it is still there."""
    stay = Window.partitionBy("path", "blob").orderBy("version")
    stays = (
        read_history(spark, history)
        .withColumn("until", F.lead("version").over(stay))
        .filter("there")
        .select("path", "blob", F.col("version").alias("since"), "until")
    )
    return stays.join(blob_findings(spark, ledger, rules), "blob").select("path", "blob", "since", "until", "spans")
