"""Left join to a lookup table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.operators.columns import flat, quoted, require_unique

_KEY = "__lookup_key"
_SALT = "__lookup_salt"
_RIGHT_SALT = "__lookup_right_salt"
_COPIES = "__lookup_copies"
_BLOCK_ROWS = 65536

#: Keys that the search for hot ones keeps counts of.
_TRACKED = 10_000

#: Tasks that rows with a null key are dealt to.
NULL_SPREAD = 256


def lookup_left_join(
    df: DataFrame,
    lookup: DataFrame,
    left_key: str,
    right_key: str,
    take: Mapping[str, str],
    salts: int = 1,
    salt_by: Sequence[str] | None = None,
    fold_copies: bool = False,
    hot_keys: Sequence | None = None,
) -> DataFrame:
    """Add columns of ``lookup`` to ``df`` where ``left_key = right_key``.

    ``take`` maps lookup columns to the names they get. Rows without a match
    and rows with a null key keep nulls; a key that occurs more than once in
    the lookup gives that many rows. The lookup's own key is not kept.

    The lookup is cut down to the columns it adds, and carries no hint: Spark
    broadcasts it only if it is below ``spark.sql.autoBroadcastJoinThreshold``
    and otherwise sort-merges. Rows with a null key are then dealt out over many
    tasks by a second key that no lookup row answers to; adaptive execution
    splits other hot left keys, as a left outer join allows.

    ``salts`` > 1 does that split in the plan, for sessions without adaptive
    execution: left rows with a hot key go to ``salts`` tasks, and lookup rows
    of hot keys, but no others, are repeated once per salt. ``hot_keys`` names
    them; else one more job over the key column finds those with a ``salts``-th
    of the rows or more (so at most ``salts`` keys). The salt is a hash of ``salt_by`` (by
    default every column that can be hashed), so a task that is run again gives
    the same rows.

    ``fold_copies`` is for a lookup that repeats its rows, as a table made by
    unpacking does. Copies are counted before the lookup is shuffled or
    broadcast, which then holds each row once however often it occurs, and
    joined rows are repeated that many times: the result is the same.
    """
    right = lookup.selectExpr(
        *(f"{quoted(name)} AS {quoted(alias)}" for name, alias in ((right_key, _KEY), *take.items()))
    )
    if fold_copies:
        right = _folded(right)
    by = salt_by or [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    deal = lambda n: F.pmod(F.xxhash64(*(flat(c) for c in by)), F.lit(n)).cast("int")
    salt = F.when(flat(left_key).isNull(), deal(NULL_SPREAD)).otherwise(F.lit(0))
    # Always 0, but no constant: the planner would fold that and drop the second key.
    right_salt = F.pmod(F.hash(flat(_KEY)), F.lit(1))
    if salts > 1:
        hot = list(hot_keys) if hot_keys is not None else _hot_keys(df, left_key, salts)
        if hot:
            salt = F.when(flat(left_key).isin(hot), deal(salts)).otherwise(salt)
            right_salt = F.explode(_when_hot(hot, salts))
    df = df.withColumn(_SALT, salt)
    right = right.withColumn(_RIGHT_SALT, right_salt)
    on = (flat(left_key) == flat(_KEY)) & (flat(_SALT) == flat(_RIGHT_SALT))
    joined = require_unique(df.join(right, on, "left").drop(_KEY, _SALT, _RIGHT_SALT))
    return _repeated(joined) if fold_copies else joined


def _when_hot(hot: Sequence, salts: int) -> Column:
    """The salts of a lookup row."""
    return F.when(flat(_KEY).isin(list(hot)), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))


def _hot_keys(df: DataFrame, key: str, salts: int) -> list:
    """Keys with a ``salts``-th of the rows or more, by one aggregate of the key column.

    The sketch counts frequent keys to within a small part of the rows, so a key that has
    just about that share may be taken for hot or not; that only decides where rows are joined.
    """
    top = F.expr(f"approx_top_k({quoted(key)}, {salts + 1}, {max(_TRACKED, 4 * (salts + 1))})")
    found = df.agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    return [r["item"] for r in found["top"] if r["item"] is not None and r["count"] * salts >= found["n"]]


def _folded(right: DataFrame) -> DataFrame:
    """Each lookup row once with its number of copies, in parts of at most a block, so that no array grows with it."""
    counted = right.groupBy(*(quoted(c) for c in right.columns)).agg(F.count(F.lit(1)).alias(_COPIES))
    parts = F.expr(
        f"transform(sequence(0L, ({_COPIES} - 1) div {_BLOCK_ROWS}), "
        f"i -> least({_BLOCK_ROWS}L, {_COPIES} - i * {_BLOCK_ROWS}))"
    )
    return counted.withColumn(_COPIES, F.explode(parts))


def _repeated(df: DataFrame) -> DataFrame:
    """Each row as often as its count of copies says; once without a count."""
    names = [quoted(c) for c in df.columns if c != _COPIES]
    return df.selectExpr(*names, f"explode(sequence(1L, coalesce({_COPIES}, 1L))) AS {_COPIES}").drop(_COPIES)
