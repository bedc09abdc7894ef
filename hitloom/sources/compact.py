"""Splitting JSON arrays of any size and any white space into their elements, by many tasks.

A file is read in pieces that end at closing braces, so it splits like a text
file. Whether a brace closes an element depends on all text before it: on being
inside a string, and on the depth. Both come from sums. A piece changes them by
its quotes and by its brackets outside strings, counted for both cases of where
it may start. Per block (up to `PIECES` consecutive pieces of a task's range of a
file, gathered as one array) these add up to the change that the block makes;
running sums over the blocks of a file, a row for each, give the state every
block starts in; and from there one pass over the block's array gives the state
at each of its braces. Elements end where the depth falls to that of the array.
Those that lie across blocks are put together from the first and last
fragments of each block, first within a task's range, then within the file.

Numbers are shuffled for the blocks' states, then every piece once, as part of its
block, and the fragments at the ends of blocks. Nothing is sorted but blocks' own
arrays and these fragments. Files are read twice; nothing is parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BLANKS = " \t\r\n"
_CLOSING = "}"

#: Pieces of a block: a few MB of ordinary text. Up to 128 blocks of a task are gathered without sorting.
PIECES = 1 << 14

#: Pieces of a block whose ends are listed at a time, since a list is copied when it grows.
_LISTED = 512


def _count(text: Column, character: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(character), F.lit("")))


def _depth_change(text: Column) -> Column:
    """Of a piece that starts outside a string, less its closing brace."""
    outside = F.regexp_replace(text, '"[^"]*("|$)', "")
    return _count(outside, "{") + _count(outside, "[") - _count(outside, "]")


def _pieces(spark: SparkSession, export: str | list[str]) -> DataFrame:
    """(file, block, id, value): texts between closing braces; ``id`` rises within a block, ``block`` within a file."""
    pieces = (
        spark.read.option("lineSep", _CLOSING)
        .text(export)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("id"),
            "value",
        )
    )
    block = F.struct("start", F.floor(F.col("id") / PIECES).alias("part"))
    return pieces.select("file", block.alias("block"), "id", "value")


def _measured(pieces: DataFrame) -> DataFrame:
    """Whether a piece has odd quotes, and its change of depth, closing brace included, if it starts outside (``out``) or inside (``within``) a string."""
    plain = F.when(F.col("value").contains("\\"), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    found = pieces.withColumn("plain", plain).withColumn("odd", _count(F.col("plain"), '"') % 2 == 1)
    after_string = F.regexp_replace("plain", '^[^"]*("|$)', "")
    return found.select(
        *pieces.columns,
        "odd",
        (_depth_change(F.col("plain")) - F.when(F.col("odd"), 0).otherwise(1)).alias("out"),
        (_depth_change(after_string) - F.when(F.col("odd"), 1).otherwise(0)).alias("within"),
    )


def _gathered(pieces: DataFrame, *names: str) -> DataFrame:
    """(file, block, pieces): a row for each block, its pieces in order."""
    in_order = F.array_sort(F.collect_list(F.struct("id", *names)))
    return pieces.groupBy("file", "block").agg(in_order.alias("pieces"))


def _block_change() -> Column:
    """(odd, out, within) of all pieces in a row."""
    zero = F.struct(F.lit(False).alias("odd"), F.lit(0).cast("long").alias("out"), F.lit(0).cast("long").alias("within"))

    def add(before: Column, piece: Column) -> Column:
        return F.struct(
            (before["odd"] != piece["odd"]).alias("odd"),
            (before["out"] + F.when(before["odd"], piece["within"]).otherwise(piece["out"])).alias("out"),
            (before["within"] + F.when(before["odd"], piece["out"]).otherwise(piece["within"])).alias("within"),
        )

    return F.aggregate("pieces", zero, add)


def block_states(spark: SparkSession, export: str | list[str]) -> DataFrame:
    """(file, block, inside, depth, next_depth, last, next_inside): the state each block starts in, and the one it ends in."""
    gathered = _gathered(_measured(_pieces(spark, export)).drop("value"), "odd", "out", "within")
    blocks = gathered.select("file", "block", _block_change().alias("change")).select("file", "block", "change.*")
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    odd = F.col("odd").cast("int")
    inside = F.coalesce(F.sum(odd).over(before), F.lit(0)) % 2 == 1
    change = F.when(F.col("inside"), F.col("within")).otherwise(F.col("out"))
    states = blocks.withColumn("inside", inside).withColumn("change", change)
    return states.select(
        "file",
        "block",
        "inside",
        F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"),
        F.sum("change").over(in_file.rowsBetween(Window.unboundedPreceding, 0)).alias("next_depth"),
        F.lead("block").over(in_file).isNull().alias("last"),
        (F.col("inside") != F.col("odd")).alias("next_inside"),
    )


def _ends() -> Column:
    """The numbers (from 1) of the pieces that an element ends with, from the state the block starts in."""

    def state(inside: Column, depth: Column, ends: Column) -> Column:
        return F.struct(inside.alias("inside"), depth.alias("depth"), ends.alias("ends"))

    nothing = F.array().cast("array<int>")

    def over_part(before: Column, low: Column) -> Column:
        def over_piece(at: Column, number: Column) -> Column:
            piece = F.get("pieces", number - 1)
            inside = at["inside"] != piece["odd"]
            depth = at["depth"] + F.when(at["inside"], piece["within"]).otherwise(piece["out"])
            ends = F.when(~inside & (depth == 1), F.concat(at["ends"], F.array(number))).otherwise(at["ends"])
            return state(inside, depth, ends)

        numbers = F.sequence(low, F.least(low + _LISTED - 1, F.size("pieces")))
        part = F.aggregate(numbers, state(before["inside"], before["depth"], nothing), over_piece)
        # Wrapped, so that it is computed once.
        added = F.transform(F.array(part), lambda p: state(p["inside"], p["depth"], F.concat(before["ends"], p["ends"])))
        return F.get(added, F.lit(0))

    lows = F.sequence(F.lit(1), F.size("pieces"), F.lit(_LISTED))
    return F.aggregate(lows, state(F.col("inside"), F.col("depth"), nothing), over_part)["ends"]


def block_fragments(spark: SparkSession, export: str | list[str], states: DataFrame) -> DataFrame:
    """(file, block, number, text, ended): a block's text, cut after each element that ends in it.

    ``states`` are the files' `block_states`. The files must be cut into the same blocks both
    times, which depends on the session; a block without a state fails the job.
    """
    gathered = _gathered(_measured(_pieces(spark, export)), "value", "odd", "out", "within")
    found = gathered.join(states.select("file", "block", "inside", "depth"), ["file", "block"], "left")
    other = F.raise_error(F.concat(F.lit("cut into other blocks when read again: "), F.col("file"))).cast("boolean")
    found = found.withColumn("inside", F.coalesce("inside", other)).withColumn("ends", _ends())
    bounds = F.concat(F.array(F.lit(0)), F.col("ends"), F.array(F.size("pieces")))
    found = found.select("file", "block", "pieces", bounds.alias("bounds"))

    def fragment(k: Column) -> Column:
        low = F.get("bounds", k)
        own = F.slice("pieces", low + 1, F.get("bounds", k + 1) - low)
        text = F.concat(F.array_join(F.transform(own, lambda p: p["value"]), _CLOSING), F.lit(_CLOSING))
        return F.struct(k.alias("number"), F.when(F.size(own) > 0, text).alias("text"), (k < F.size("bounds") - 2).alias("ended"))

    each = F.explode(F.transform(F.sequence(F.lit(0), F.size("bounds") - 2), fragment))
    return found.select("file", "block", each.alias("fragment")).select("file", "block", "fragment.*").filter("text is not null")


def check_ends(states: DataFrame) -> None:
    """Raise for files that are cut off or not one array each, by the state that their last block ends in."""
    # "[" and "]" cancel out; the file's last piece counts a brace that is not there.
    is_whole = (F.col("next_depth") == -1) & ~F.col("next_inside")
    if cut_off := states.filter(F.col("last") & ~is_whole).select("file").limit(5).collect():
        raise ValueError(f"cut off, or not one JSON array: {', '.join(r.file for r in cut_off)}")


def compact_elements(fragments: DataFrame) -> DataFrame:
    """Elements (``value``) of files that are one JSON array of objects each, as text on one line.

    ``fragments`` are the files' `block_fragments`. Anything else than objects in an
    array, or anything beside it, fails the job.
    """
    is_edge = (F.col("number") == 0) | ~F.col("ended")
    in_range = _joined(fragments.filter(is_edge), F.struct("block.start"))
    in_file = _joined(in_range.filter(is_edge), F.lit(None))
    inner = [part.filter(~is_edge).select("file", F.lit(False).alias("first"), "text", "ended") for part in (fragments, in_range)]
    outer = in_file.select("file", (F.col("number") == 0).alias("first"), "text", "ended")
    return inner[0].unionByName(inner[1]).unionByName(outer).select(_checked().alias("value")).filter("value is not null")


def _joined(edges: DataFrame, block: Column) -> DataFrame:
    """Fragments of larger blocks, put together from all fragments at the edges of smaller ones."""
    edges = edges.select("file", block.alias("larger"), "block", "number", "text", "ended")
    in_order = Window.partitionBy("file", "larger").orderBy("block", "number")
    begins = (F.col("number") > 0) | F.lag("ended", 1, True).over(in_order)
    numbered = edges.withColumn("begins", begins).withColumn("element", F.sum(F.col("begins").cast("int")).over(in_order))
    parts = F.array_sort(F.collect_list(F.struct("block", "number", "text")))
    text = F.array_join(F.transform(parts, lambda p: p["text"]), "")
    made = numbered.groupBy("file", "larger", "element").agg(text.alias("text"), F.bool_or("ended").alias("ended"))
    return made.select("file", F.col("larger").alias("block"), (F.col("element") - 1).alias("number"), "text", "ended")


def _checked() -> Column:
    """An element without what parts it from the one before; null for the end of the array."""
    body = F.ltrim("text", F.lit(_BLANKS))
    opening = F.when(F.col("first"), F.lit("[")).otherwise(F.lit(","))
    element = F.ltrim(F.substr(body, F.lit(2)), F.lit(_BLANKS))
    is_element = F.col("ended") & body.startswith(opening) & element.startswith("{")
    # The array's end, with the brace that is not there; of an empty array the beginning as well.
    is_end = ~F.col("ended") & F.translate("text", _BLANKS, "").isin("]" + _CLOSING, "[]" + _CLOSING)
    refused = F.raise_error(F.concat(F.lit("not a JSON array of objects: "), F.col("file")))
    return F.when(is_element, F.translate(element, "\r\n", "")).when(~is_end, refused)
