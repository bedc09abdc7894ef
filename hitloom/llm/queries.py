"""One query per operator, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm.common import table, whole_text, words
from hitloom.llm.decontaminate import SHARE, SHINGLE_WORDS, contained_items
from hitloom.llm.exact_dedup import exact_duplicates
from hitloom.llm.labelled import fold
from hitloom.llm.langid import identify
from hitloom.llm.packing import pack_documents
from hitloom.llm.quality_cnn import quality_scores
from hitloom.llm.quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS, apply_rules
from hitloom.llm.repeats import repeats
from hitloom.llm.runs import periodic_runs
from hitloom.llm.secret_scan import RULES as SECRET_RULES
from hitloom.llm.secret_scan import find_secrets, spans_text
from hitloom.llm.simhash import near_duplicates
from hitloom.llm.toxicity import toxicity_scores
from hitloom.llm.warc import archive_pages
from hitloom.llm.whitening import whiten


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), width=3, distance=3)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = archive_pages(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 0
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 3) == 1
    scores = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 0
    found = identify(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def _looped_words(docs: DataFrame) -> DataFrame:
    """(doc_id, words): a tenth of the documents repeat a stretch of theirs to the end, by the hash of the id."""
    split = docs.select("doc_id", F.crc32(F.col("doc_id").cast("string")).alias("h"), words(whole_text()).alias("w"))
    n, g = F.size("w").cast("long"), F.floor(F.col("h") / 10)
    first = g % n
    period = 1 + F.floor((n - first) / (3 + g % 8))
    at = lambda i: F.get("w", F.when(i < first, i).otherwise(first + (i - first) % period).cast("int"))
    looped = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), at)
    return split.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), looped).otherwise(F.col("w")).alias("words"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_looped_words(table(spark, sf_dir, "documents")))
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    start, period = -F.col("best.s"), -F.col("best.p")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        F.col("best.length").alias("length"),
        period.alias("period"),
        F.floor(1000 * F.col("best.length") / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.col("keep").alias("keep_id"), "group_size", "kept", F.col("sha256").alias("text_sha256")
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["base"])
    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def _rules_sql() -> str:
    parts = ["true"]
    for r in RULES:
        if r.low is not None:
            parts.append(f"{r.numerator} * 100 >= {r.denominator} * {r.low}")
        if r.high is not None:
            parts.append(f"{r.numerator} * 100 <= {r.denominator} * {r.high}")
    return " AND ".join(parts)


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

OP1_SQL = rf"""
WITH t AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), g AS (
    SELECT r, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i+2])) AS g,
           unnest(range(1, len(w) - 1)) AS i
    FROM t
), d AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g
), c AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM d WHERE n > 1) GROUP BY r
), k AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(list_aggregate(w, 'string_agg', '')) AS BIGINT) AS wc,
           CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(regexp_extract_all(t, '!')) AS BIGINT) AS n_exclamations,
           CAST(len(l) AS BIGINT) AS n_lines,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           CAST(len(list_filter(w, lambda x: x IN ({_STOP}))) AS BIGINT) AS n_stop_words
    FROM t LEFT JOIN c USING (r)
), v AS (
    SELECT * EXCLUDE (wc), coalesce(wc, 0) AS word_chars,
           n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed
    FROM k
)
SELECT *, NOT base_failed AND {_rules_sql()} AS kept FROM v
"""

def _shingle_sql(source: str, key: str) -> str:
    last = SHINGLE_WORDS - 1
    return rf"""SELECT DISTINCT {key}, unnest(CASE
            WHEN len(w) >= {SHINGLE_WORDS} THEN
                list_transform(range(1, len(w) - {last - 1}), lambda i: array_to_string(w[i:i+{last}], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
        FROM (SELECT {key}, list_filter(
            regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda x: x <> '') AS w
            FROM {source} WHERE {key} IS NOT NULL)"""


OP3_SQL = f"""
WITH d AS ({_shingle_sql("documents", "doc_id")}),
     b AS ({_shingle_sql("benchmark", "item_id")}),
     n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id),
     m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM m JOIN n USING (item_id) WHERE n_shared * 100 >= n_item * {SHARE}
"""


def _secret_sql() -> str:
    parts = []
    for rank, r in enumerate(SECRET_RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""SELECT r, {rank} AS rank, '{r.kind}' AS kind, {str(r.base).lower()} AS base,
            unnest(range(1, len(m) + 1)) AS k, g, m, v, {r.least} AS least
        FROM (SELECT r, regexp_split_to_array(t, '{pattern}') AS g, regexp_extract_all(t, '{pattern}', 0) AS m,
                     regexp_extract_all(t, '{pattern}', {r.value}) AS v FROM t)""")
    return " UNION ALL ".join(parts)


OP7_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
x AS ({_secret_sql()}),
s AS (
    SELECT r, rank, kind, base,
           list_sum(list_transform(g[1:k], lambda y: length(y)))
           + coalesce(list_sum(list_transform(m[1:k-1], lambda y: length(y))), 0) AS a, length(m[k]) AS n
    FROM x WHERE length(v[k]) >= least
), p AS (
    SELECT r, rank, kind, base, CAST(a AS BIGINT) AS a,
           kind || ':' || CAST(a AS BIGINT) || ':' || CAST(a + n AS BIGINT) AS span FROM s
), f AS (
    SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(span, ',' ORDER BY a, rank) FILTER (base) AS b, string_agg(span, ',' ORDER BY a, rank) AS spans
    FROM p GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN f USING (r)
"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v[{i}] >> {35 - 5 * j}) & 31 AS INTEGER) + 1, 1)"
    for i in range(1, 5)
    for j in range(8)
)

OP4_SQL = f"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS t, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
), s AS (
    SELECT *, sha1(t) AS h FROM p
), b AS (
    SELECT *, [CAST('0x' || substr(h, 10 * i + 1, 10) AS BIGINT) FOR i IN range(4)] AS v FROM s
)
SELECT page_id, strlen(t) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN first < page_id OR (page_id IS NULL AND first IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id OR page_id IS NULL THEN first END AS refers_to
FROM b
"""

# Places are cut from pieces of 2,048 bytes: a substring costs time in proportion to where it lies.
OP10_SQL = """
WITH d AS (
    SELECT doc_id, hex(coalesce(text, '')) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents
), pieces AS (
    SELECT doc_id, n, i, substr(h, 2 * i + 1, 2 * (2048 + 99)) AS piece
    FROM (SELECT doc_id, n, h, unnest(range(0, n, 2048)) AS i FROM d)
), places AS (
    SELECT doc_id, i + k AS p, substr(piece, 2 * k + 1, 200) AS s
    FROM (SELECT doc_id, n, i, piece, unnest(range(0, 2048)) AS k FROM pieces) WHERE i + k + 100 <= n
), again AS (
    SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS r FROM places) WHERE r > 1
), marked AS (
    SELECT doc_id, p, p > coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100, -1) AS new FROM again
), runs AS (
    SELECT doc_id, min(p) AS a, max(p) + 100 AS b
    FROM (SELECT doc_id, p, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked)
    GROUP BY doc_id, run
), gaps AS (
    SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS low, a AS high FROM runs
    UNION ALL SELECT doc_id, max(b), NULL FROM runs GROUP BY doc_id
), kept AS (
    SELECT g.doc_id, string_agg(substr(h, 2 * low + 1, 2 * (coalesce(high, n) - low)), '' ORDER BY low) AS h
    FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id
), counts AS (
    SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id
)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

OP13_SQL = """
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST, r) = 1 AS kept, sha256(t) AS text_sha256
FROM t
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash": op2_simhash,
    "op3_decontaminate": op3_decontaminate,
    "op4_warc": op4_warc,
    "op5_quality_cnn": op5_quality_cnn,
    "op6_toxicity": op6_toxicity,
    "op7_secret_scan": op7_secret_scan,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_repeats": op10_repeats,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_whitening": op12_whitening,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": OP1_SQL,
    "op3_decontaminate": OP3_SQL,
    "op4_warc": OP4_SQL,
    "op7_secret_scan": OP7_SQL,
    "op10_repeats": OP10_SQL,
    "op13_exact_dedup": OP13_SQL,
}
