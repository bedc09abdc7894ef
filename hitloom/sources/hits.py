"""Exported search hits and the bronze layer.

Bronze holds one hit per line, so that any number of tasks can read it. Nothing
that cannot be read becomes a null row: reading fails, or, where the caller asks
for it, bad lines are kept apart as rejects.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, StringType, StructField, StructType

from hitloom.sources.compact import block_fragments, block_states, check_ends, compact_elements
from hitloom.sources.mixed import with_mixed_arrays

_BLANKS = " \t\r\n"
_CORRUPT = "_corrupt_record"

#: How bronze files are written that no caller has options for. Hits repeat their names, so text is a tenth of its size
#: compressed. A compressed file is read by one task: the bound on its hits keeps that task's share small.
BRONZE_FILES = {"compression": "gzip", "maxRecordsPerFile": "1000000"}

# The types of the fields every hit has; inference would call a field that is always null a string.
ENVELOPE = {"_id": StringType(), "_index": StringType(), "_score": DoubleType()}


def case_sensitive(spark: SparkSession) -> bool:
    """Whether the session tells names apart by case."""
    return spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"


def envelope_schema(schema: StructType) -> StructType:
    """An inferred schema with the known types of the envelope."""
    return StructType([StructField(f.name, ENVELOPE.get(f.name, f.dataType), f.nullable, f.metadata) for f in schema.fields])


def read_hits(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "json",
    schema: StructType | str | None = None,
    mixed_arrays: bool = False,
    **options: str,
) -> DataFrame:
    """Read hits; one row per hit, as stored.

    JSON without a ``schema`` is read twice: once in full to infer the schema
    (conflicting types widen to string), once for the data. Pass ``schema`` to
    save the first pass. Types of the envelope (``_id``, ``_index``, ``_score``)
    are not inferred. Malformed text, and values that the schema cannot hold,
    fail the query unless ``mode`` says otherwise; :func:`split_rejects` keeps
    them apart. ``multiLine="true"`` reads whole-file documents, one task per
    file; use :func:`land_bronze` to get out of that.

    ``mixed_arrays`` is for line-delimited JSON with fields that are an array in some hits and a
    single value in others: they become arrays (of one) in all, so that unpacking gives a row per
    element instead of one with the array as text. It takes no ``schema`` and reads the lines
    twice more, or once more per level of such fields in each other.
    """
    if mixed_arrays:
        if schema is not None or fmt != "json" or options:
            raise ValueError("mixed_arrays infers its own schema from line-delimited JSON, without options")
        lines = spark.read.text(path).filter(F.trim("value", F.lit(_BLANKS)) != "")
        return with_mixed_arrays(lines, ENVELOPE)
    if fmt == "json":
        options = {"mode": "FAILFAST", **options}
    reader = spark.read.format(fmt).options(**options)
    if schema is None and fmt == "json":
        schema = envelope_schema(reader.load(path).schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def split_rejects(
    spark: SparkSession, path: str | list[str], schema: StructType | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Hits of a bronze layer, and the lines (``value``) that are none.

    A line is rejected if it is malformed, no JSON object, or holds a value
    that the schema cannot. Without a ``schema``, it is inferred from the lines that parse.
    """
    if schema is None:
        parsed = spark.read.options(mode="DROPMALFORMED").json(path).schema
        schema = envelope_schema(StructType([f for f in parsed.fields if f.name != _CORRUPT]))
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    marked = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    lines = spark.read.text(path).filter(F.trim("value", F.lit(_BLANKS)) != "")
    hit = F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    parsed = lines.select("value", hit.alias("hit"))
    bad = F.col("hit").isNull() | F.col(f"hit.{_CORRUPT}").isNotNull() | ~F.ltrim("value", F.lit(_BLANKS)).startswith("{")
    good = parsed.filter(~bad).select("hit.*").drop(_CORRUPT)
    return good, parsed.filter(bad).select("value")


def narrow_schema(schema: StructType, reads: Collection[str], by_case: bool = False) -> StructType:
    """The part of ``schema`` that the flat names ``reads`` need.

    Names are compared without regard to case unless ``by_case``.

    Scalars that are not named go; arrays always stay, since they decide how
    many rows a record becomes. Given to the JSON reader, the result keeps the
    parser from materialising fields nobody uses: Spark does not prune nested
    fields of JSON by itself.
    """
    fold = str if by_case else str.lower
    narrowed = _narrow("", schema, frozenset(map(fold, reads)), fold)
    return narrowed if isinstance(narrowed, StructType) else schema


def _narrow(name: str, dtype: DataType, reads: frozenset[str], fold: Callable[[str], str]) -> DataType | None:
    if isinstance(dtype, ArrayType):
        # An array that holds nothing of use is kept whole: its length matters.
        return ArrayType(_narrow(name, dtype.elementType, reads, fold) or dtype.elementType, dtype.containsNull)
    if isinstance(dtype, StructType):
        prefix = f"{name}." if name else ""
        kept = [
            StructField(f.name, narrowed, f.nullable, f.metadata)
            for f in dtype.fields
            if (narrowed := _narrow(prefix + f.name, f.dataType, reads, fold)) is not None
        ]
        return StructType(kept) if kept else None
    return dtype if fold(name) in reads else None


def write_bronze(df: DataFrame, path: str, **options: str) -> None:
    """Replace ``path`` with the rows of ``df`` as one JSON object per line.

    Null fields are written, so that the schema read back is the same. Files are
    compressed as `BRONZE_FILES` says; ``options`` win (``compression="none"``).
    """
    df.write.mode("overwrite").options(**{"ignoreNullFields": "false", **BRONZE_FILES, **options}).json(path)


def land_bronze(
    spark: SparkSession,
    export: str | list[str],
    path: str,
    layout: str = "lines",
    indent: int = 4,
    **options: str,
) -> None:
    """Replace ``path`` with the hits of an export, one per line.

    ``layout`` says what the export looks like:

    - ``lines``: one hit per line already. Copied as text, byte for byte. A
      line that opens or closes an array is refused: the export has another layout.
    - ``indented``: one JSON array, pretty-printed with ``indent`` spaces per
      level. Only an element of the outer array can end in a line break,
      ``indent`` spaces and a brace (deeper braces stand further right, and a
      line break inside a string is escaped), so that is the record separator:
      a file of any size is split over many tasks, and hits are copied without
      being parsed, less their line breaks.
    - ``compact``: one JSON array of objects, in any white space or none. Text is
      cut where the depth, summed up over all blocks of the file, falls to that of
      the array: a file of any size is split over many tasks, at the price of one
      shuffle of its text. Hits are copied without being parsed, less line breaks.
    - ``document``: any other JSON array (or one object). Each file is parsed by
      one task and must fit into a string of it (2 GB); hits keep their own
      structure, whatever the others have, only numbers are written plainly.

    Files that do not have the layout fail the job: text that is cut off,
    or malformed, never turns into missing or empty hits.

    ``options`` are for writing bronze: it is plain text unless they say
    otherwise (`BRONZE_FILES` does, which a topic's run uses). An export of
    lines may be compressed.
    """
    exports = [export] if isinstance(export, str) else export
    if any(f"{one.rstrip('/')}/".startswith(f"{path.rstrip('/')}/") for one in exports):
        raise ValueError(f"the export lies inside {path}, which landing it would replace")
    if layout == "document":
        lines = _document_elements(spark, export)
    elif layout == "lines":
        line = F.trim("value", F.lit(_BLANKS))
        is_layout = line.isin("[", "]", "{", "}", "},") | line.startswith("[")
        refused = F.raise_error(F.lit("a line of a JSON array, not a hit: the export has another layout"))
        lines = spark.read.text(export).filter(line != "").select(F.when(~is_layout, F.col("value")).otherwise(refused).alias("value"))
    elif layout == "indented":
        lines = _indented_elements(spark, export, " " * indent)
    elif layout == "compact":
        _land_compact(spark, export, path, options)
        return
    else:
        raise ValueError(f"layout {layout!r}: expected 'lines', 'indented', 'compact' or 'document'")
    lines.write.mode("overwrite").options(**options).text(path)


def _land_compact(spark: SparkSession, export: str | list[str], path: str, options: dict) -> None:
    states = block_states(spark, export).persist()
    try:
        check_ends(states)
        compact_elements(block_fragments(spark, export, states)).write.mode("overwrite").options(**options).text(path)
    finally:
        states.unpersist()


def _document_elements(spark: SparkSession, export: str | list[str]) -> DataFrame:
    """Elements of whole-file arrays, as compact text."""
    whole = F.trim("value", F.lit(_BLANKS))
    array = F.when(whole.startswith("{"), F.concat(F.lit("["), whole, F.lit("]"))).otherwise(whole)
    documents = spark.read.text(export, wholetext=True).filter(whole != "").select(array.alias("value"))
    elements = F.from_json("value", "array<string>", {"mode": "FAILFAST"})
    return documents.select(F.explode(elements).alias("value"))


def _indented_elements(spark: SparkSession, export: str | list[str], margin: str) -> DataFrame:
    closing = f"\n{margin}}}"
    # Cut after every element but a file's last, which ends in "}\n]" instead.
    pieces = spark.read.option("lineSep", closing + ",").text(export)
    piece = F.col("value")
    starts = piece.startswith(f"\n{margin}{{") | piece.startswith(f"[\n{margin}{{")
    # Only the outer array's bracket stands at the start of a line.
    is_last = piece.contains("\n]")
    body = F.ltrim(piece, F.lit("[" + _BLANKS))
    element = F.when(is_last, F.rtrim(body, F.lit("]" + _BLANKS))).otherwise(
        F.concat(body, F.lit(closing))
    )
    # Line breaks here are layout only; inside strings they are escaped.
    one_line = F.replace(element, F.lit("\n"), F.lit(""))
    checked = F.when(starts, one_line).otherwise(
        F.raise_error(F.lit(f"not a JSON array indented by {len(margin)} spaces per level"))
    )
    is_empty = F.trim(piece, F.lit("[]" + _BLANKS)) == ""
    # Pieces do not know whether the file goes on, so whole files are checked: each array is closed once, at its end.
    closes = (is_last | (is_empty & piece.contains("]"))) & F.rtrim(piece, F.lit(_BLANKS)).endswith("]")
    closed = pieces.groupBy("_metadata.file_path").agg(F.sum(closes.cast("int")).alias("n"))
    if cut_off := closed.filter("n <> 1").limit(5).collect():
        raise ValueError(f"cut off, or not one JSON array: {', '.join(r.file_path for r in cut_off)}")
    return pieces.filter(starts | ~is_empty).select(checked.alias("value"))
