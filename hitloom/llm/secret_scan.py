"""Secret scans over an incremental blob ledger.

Texts are content-addressed: a blob is a text's SHA-256, and equal texts under
any number of paths (here: row ids) are one blob. The ledger is a table in a
shared folder with one row per scan of a blob: which rule versions ran and what
they matched. A scan looks only at blobs with a rule version that the ledger
does not hold yet, appends its rows in one commit (a failed or repeated task
leaves nothing behind), and findings are joined back to all paths.

All is DataFrame functions. Spans come from two built-in calls with the same
pattern: the pieces between matches and the matches; running sums of their
lengths are the offsets, in code points, end exclusive.

Defined cases: null text is the empty text; rows without an id, repeated rows
and ids are kept, one result row each; an empty table gives no rows and an
empty ledger entry; other columns are not looked at. A blob is scanned once even
if a third of all rows share it: copies are merged on the map side first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitloom.llm.common import BROADCAST_ROWS, let, saved, scratch_dir, whole_text


@dataclass(frozen=True)
class SecretRule:
    """``hint`` is a cheaper pattern that every match contains; group ``value`` must have ``least`` characters.

    The first ``lead`` characters of a match are a public marker, which masks may leave where another span covers all
    that comes after it. A change of any field but ``version`` and ``lead`` must come with a new version.
    """

    kind: str
    version: int
    pattern: str
    hint: str
    value: int = 0
    least: int = 1
    base: bool = False
    lead: int = 0

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


# A private key with its body: up to the END line, whatever the lines between look like (no five hyphens). Without
# an END line: header fields, then up to 200 long runs of base64 and a shorter one with padding.
_BASE64 = "[A-Za-z0-9+/=]"
_BREAK = r"[\x20\t\r\n\\]+"  # line ends may be written as \n
_KEY_END = r"[^-]*(?:-{1,4}[^-]+){0,64}-----END [A-Z ]*PRIVATE KEY-----"
_KEY_CUT = (
    r"(?:[\r\n]+[A-Za-z]+-[A-Za-z]+:[^\r\n]*){0,4}"
    rf"(?:{_BREAK}{_BASE64 * 16}{_BASE64}*){{0,200}}(?:{_BREAK}[A-Za-z0-9+/]+={{1,2}})?"
)

# The base kinds, in the order in which they are listed, then our own.
RULES = (
    SecretRule(
        "assign",
        1,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"(?i:password|passwd|secret|token|api_?key)",
        value=2,
        least=6,
        base=True,
    ),
    SecretRule("access", 1, r"AKIA[A-Z0-9]+", "AKIA", least=20, base=True),
    SecretRule("hex", 1, r"[0-9a-f]+", "[0-9a-f]{24}", least=24, base=True),
    SecretRule("key_block", 2, rf"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:{_KEY_END}|{_KEY_CUT})", "-----BEGIN "),
    SecretRule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ"),
    SecretRule("github", 1, r"gh[opsur]_[A-Za-z0-9]{36,}", r"gh[opsur]_", lead=4),
)

_RAW = "array<struct<rule:string,gap:int,size:int,ok:boolean>>"
LEDGER_SCHEMA = f"blob string, rules array<string>, raw {_RAW}"


def _matches(text: Column, rule: SecretRule) -> Column:
    """Per match: characters since the match before, its size, and whether it counts."""
    # Runs that can't count are no use as anchors of other runs here, so they need not be listed.
    pattern = rule.pattern.replace("[0-9a-f]+", "[0-9a-f]{24,}") if rule.kind == "hex" and rule.least == 24 else rule.pattern
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.value)).alias("value"),
    )
    listed = F.transform(
        F.filter(found, lambda x: x["all"].isNotNull()),
        lambda x: F.struct(
            F.lit(rule.id).alias("rule"),
            F.char_length(x["gap"]).alias("gap"),
            F.char_length(x["all"]).alias("size"),
            (F.char_length(x["value"]) >= rule.least).alias("ok"),
        ),
    )
    return F.when(text.rlike(rule.hint), listed).otherwise(F.array().cast(_RAW))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The ledger's rows, or None before its first scan."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan(docs: DataFrame, ledger: str, text: str = "text", rules: Sequence[SecretRule] = RULES) -> None:
    """Bring the ledger up to date with these texts and rules."""
    spark = docs.sparkSession
    known = F.array(*(F.lit(r.id) for r in rules))
    blobs = docs.select(F.sha2(whole_text(text), 256).alias("blob"), whole_text(text).alias("t")).dropDuplicates(["blob"])
    seen = read_ledger(spark, ledger)
    if seen is None:
        todo = blobs.withColumn("todo", known)
    else:
        done = seen.select("blob", F.explode("rules").alias("r")).groupBy("blob").agg(F.collect_set("r").alias("done"))
        todo = (
            blobs.join(done, "blob", "left")
            .withColumn("todo", F.array_except(known, F.coalesce("done", F.array().cast("array<string>"))))
            .filter(F.size("todo") > 0)
        )
    none = F.array().cast(_RAW)
    raw = F.concat(*(F.when(F.array_contains("todo", r.id), _matches(F.col("t"), r)).otherwise(none) for r in rules))
    todo.select("blob", F.col("todo").alias("rules"), raw.cast(_RAW).alias("raw")).write.mode("append").parquet(ledger)


def blob_findings(spark: SparkSession, ledger: str, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """(blob, spans): for blobs with any, spans by start, then kind as listed.

    A span is (start, rank, kind, end, base). A rule version that was scanned
    twice (two scans at a time) counts once.
    """
    seen = read_ledger(spark, ledger)
    assert seen is not None, f"no ledger in {ledger}"
    order = F.create_map(*(F.lit(v) for k, r in enumerate(rules) for v in (r.id, k)))
    hits = seen.distinct().select("blob", "rules", F.posexplode("raw").alias("n", "m")).select("blob", "rules", "n", "m.*")
    hits = hits.filter(F.col("rule").isin(*(r.id for r in rules)))
    before = Window.partitionBy("blob", "rule", "rules").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("gap") + F.coalesce(F.sum(F.col("gap") + F.col("size")).over(before), F.lit(0))
    base = F.col("rule").isin(*(r.id for r in rules if r.base))
    spans = (
        hits.withColumn("start", start)
        .filter("ok")
        .withColumn("rank", order[F.col("rule")])
        .select("blob", F.struct(
            F.col("start").cast("long").alias("start"),
            F.col("rank").alias("rank"),
            F.substring_index("rule", "@", 1).alias("kind"),
            (F.col("start") + F.col("size")).cast("long").alias("end"),
            base.alias("base"),
        ).alias("span"))
    )
    return spans.groupBy("blob").agg(F.sort_array(F.collect_set("span")).alias("spans"))


def find_secrets(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    ledger: str | None = None,
    rules: Sequence[SecretRule] = RULES,
) -> DataFrame:
    """(key, spans) for every row; spans is empty where nothing was found.

    ``ledger`` is a folder all executors share; without one, a new ledger is
    made under ``spark.checkpoint.dir`` and everything is scanned.
    """
    spark = docs.sparkSession
    ledger = ledger or f"{scratch_dir(spark)}/ledger"
    scan(docs, ledger, text, rules)
    found = saved(blob_findings(spark, ledger, rules), "findings")
    paths = docs.select(F.col(key), F.sha2(whole_text(text), 256).alias("blob"))
    none = F.array().cast(dict(found.dtypes)["spans"])
    return paths.join(found, "blob", "left").select(key, F.coalesce("spans", none).alias("spans"))


def masked(text: Column, cuts: Column, mask: str = "[SECRET]") -> Column:
    """The text with each of ``cuts`` (start, end; sorted and apart) replaced, in time linear in the text."""
    mark = F.lit(b"\x00\x00\xfe\xff")  # so that no character of the text is taken for a byte order mark

    def pieces(wide: Column) -> Column:
        # Four bytes per code point: a piece is found without a look at what comes before it.
        ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda x: x["end"]))
        starts = F.concat(F.transform(cuts, lambda x: x["start"]), F.array((F.length(wide) / 4).cast("long")))
        between = F.arrays_zip(ends.alias("a"), starts.alias("z"))
        part = lambda x: F.substring(wide, (x["a"] * 4 + 1).cast("int"), ((x["z"] - x["a"]) * 4).cast("int"))
        return F.transform(between, lambda x: F.decode(F.concat(mark, part(x)), "UTF-32"))

    return F.array_join(let(F.encode(text, "UTF-32"), pieces), mask)


def _cuts(found: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
    """(blob, cuts): the union of a blob's spans; spans that only touch stay two."""
    lead = F.lit(0)
    for r in rules:
        lead = F.when(F.col("kind") == r.kind, r.lead).otherwise(lead) if r.lead else lead
    follow = F.lead(F.struct("start", "end")).over(Window.partitionBy("blob").orderBy("start", "end"))
    rest = F.col("start") + F.col("lead")
    spans = (
        found.select("blob", F.explode("spans").alias("s"))
        .select("blob", "s.start", "s.end", "s.kind")
        .withColumns({"lead": lead, "follow": follow})
        .withColumn("start", F.when((F.col("follow.start") == rest) & (F.col("follow.end") >= F.col("end")), rest).otherwise(F.col("start")))
        .select("blob", "start", "end")
    )
    before = Window.partitionBy("blob").orderBy("start", "end")
    reached = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("start") < F.col("reached"), 0).otherwise(1)
    return (
        spans.withColumn("reached", reached)
        .withColumn("part", F.sum(new).over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("blob", "part")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("blob")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    )


def mask_secrets(docs: DataFrame, text: str = "text", ledger: str | None = None, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """All rows and columns of ``docs``, with the union of the ledger's spans masked on the text as it was scanned."""
    spark = docs.sparkSession
    ledger = ledger or f"{scratch_dir(spark)}/ledger"
    scan(docs, ledger, text, rules)
    cuts = _cuts(blob_findings(spark, ledger, rules), rules)
    found = saved(cuts.select(F.col("blob").alias("__hitloom_blob"), F.col("cuts").alias("__hitloom_cuts")), "findings")
    n_cuts = found.agg(F.sum(F.size("__hitloom_cuts"))).first()[0] or 0
    return (
        docs.withColumn("__hitloom_sha", F.sha2(whole_text(text), 256))
        .join(
            F.broadcast(found) if n_cuts <= BROADCAST_ROWS else found, F.col("__hitloom_sha") == F.col("__hitloom_blob"), "left"
        )
        .withColumn(
            text, F.when(F.col("__hitloom_blob").isNotNull(), masked(F.col(text), F.col("__hitloom_cuts"))).otherwise(F.col(text))
        )
        .select(*docs.columns)
    )


def spans_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
