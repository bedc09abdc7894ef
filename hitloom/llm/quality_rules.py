"""Quality rules: a threshold table compiled into one projection.

Every rule bounds a ratio of two whole numbers in per cent, so verdicts never
depend on floating point. All is built-in functions: narrow, no shuffle, no
user function; a text of any length is one row's work.

Defined cases: null or empty text has no words and fails the base rule; a text
of fewer than three words has no repeated windows; rows, ids and ties are not
looked at, so repeated rows get equal verdicts; other columns pass untouched.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import let, whole_text, words

# Frequent function words of four languages.
STOP_WORDS_OF = {
    "en": "the of and to in is that for was with as are on be it by this at from or an he which have".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur au avec pas se il plus".split(),
    "de": "der die und das von den mit ist des im dem nicht ein eine auf für sich als auch es zu".split(),
    "es": "el y los las del una por con su para al lo como más o no de la que en un se".split(),
}
STOP_WORDS = list(dict.fromkeys(w for words_of in STOP_WORDS_OF.values() for w in words_of))

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Keep a text if ``low`` <= 100 * numerator / denominator <= ``high`` (an open end is None)."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None


#: The thresholds in use. Names of counts are those that `counts` makes.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbols", "n_symbols", "n_words", high=25),
    Rule("exclamations", "n_exclamations", "n_words", high=25),
    Rule("stop_words", "n_stop_words", "n_words", low=3),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


#: Bits of a packed window that hold its position.
_POSITION_BITS = 21
_POSITION = (1 << _POSITION_BITS) - 1


def _characters(text: Column, of: str) -> Column:
    """How many characters of a text are in ``of``."""
    return F.regexp_count(text, F.lit(f"[{re.escape(of)}]"))


def _covered(positions: Column) -> Column:
    """How many words three-word windows at these positions cover."""

    def total(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.coalesce(F.least(F.lit(3), F.get(p, j + 1) - x), F.lit(3)).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(F.sort_array(positions), total)


def _neighbours(s: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Elements of a sorted array that are the same as the one before or after."""
    twins = F.filter(
        F.sequence(F.lit(1), F.greatest(F.size(s) - 1, F.lit(1))),
        lambda j: F.coalesce(same(F.get(s, j - 1), F.get(s, j)), F.lit(False)),
    )
    return F.array_distinct(F.flatten(F.transform(twins, lambda j: F.array(F.get(s, j - 1), F.get(s, j)))))


def _repeated_words(w: Column) -> Column:
    """Words that lie in a three-word window whose words occur as a window twice or more.

    A window is packed into one long, part of its hash above its position, and
    the longs are sorted: windows of equal hash are neighbours. Their words
    are then compared; should two different windows share a hash, or the text
    be too long for the position's bits, windows are sorted by their words instead.
    """
    n = F.size(w)
    at = lambda i: (F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    starts = F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0)))
    packed = F.transform(
        starts, lambda i: F.shiftleft(F.xxhash64(*at(i)), _POSITION_BITS).bitwiseOR(i.cast("long"))
    )
    by_hash = let(
        F.sort_array(packed),
        lambda s: _neighbours(s, lambda x, y: F.shiftright(x.bitwiseXOR(y), _POSITION_BITS) == 0),
    )

    def differ(x: Column, y: Column) -> Column:
        i, j = (z.bitwiseAND(F.lit(_POSITION)).cast("int") for z in (x, y))
        return F.array(*at(i)) != F.array(*at(j))

    def collision(d: Column) -> Column:
        return F.exists(
            F.transform(
                d,
                lambda x, j: (j > 0)
                & (F.shiftright(x.bitwiseXOR(F.get(d, j - 1)), _POSITION_BITS) == 0)
                & differ(x, F.get(d, j - 1)),
            ),
            lambda x: F.coalesce(x, F.lit(False)),
        )

    by_words = let(
        F.sort_array(F.transform(starts, lambda i: F.struct(F.array(*at(i)).alias("g"), i.cast("long").alias("i")))),
        lambda s: F.transform(_neighbours(s, lambda x, y: x["g"] == y["g"]), lambda x: x["i"]),
    )
    repeated = let(
        by_hash,
        lambda d: F.when(F.size(d) == 0, F.lit(0).cast("long"))
        .when(collision(d) | (n > _POSITION), _covered(by_words))
        .otherwise(_covered(F.transform(d, lambda x: x.bitwiseAND(F.lit(_POSITION))))),
    )
    return F.when(n >= 3, repeated).otherwise(0)


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts that rules use; clashing columns of the input must have been left out by the caller."""
    split = docs.withColumn("_t", whole_text(text)).withColumn("_w", words(F.col("_t")))
    t, w = F.col("_t"), F.col("_w")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    long = {
        "n_words": F.size(w),
        "word_chars": F.char_length(F.array_join(w, "")),
        "n_symbols": _characters(t, SYMBOLS),
        "n_exclamations": _characters(t, "!"),
        "n_lines": let(lines, F.size),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": _repeated_words(w),
        "n_stop_words": F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS))),
    }
    return split.select(*docs.columns, *(v.cast("long").alias(k) for k, v in long.items()))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True if every rule holds; a denominator of zero holds."""
    holds = F.lit(True)
    for r in rules:
        top, bottom = F.col(r.numerator) * 100, F.col(r.denominator)
        if r.low is not None:
            holds = holds & (top >= bottom * r.low)
        if r.high is not None:
            holds = holds & (top <= bottom * r.high)
    return holds


def apply_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: the key, all counts, ``base_failed`` and ``kept``."""
    counted = counts(docs.select(F.col(key), F.col(text)), text).drop(text)
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return counted.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & verdict(rules))
