"""What a topic does to its records, as data.

A topic is lookups and two ordered lists of steps around the explode:
``record_steps`` want one row per record, ``row_steps`` the unpacked rows. A
step is any DataFrame-to-DataFrame function; :func:`derive`, :func:`drop`,
:func:`rename` and :func:`select` make the usual ones. Their column expressions
are built when the step runs, so a spec needs no session.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from hitloom.operators.columns import add_columns, drop_columns, rename_columns, select_columns

Step = Callable[[DataFrame], DataFrame]


def derive(columns: Callable[[], Mapping[str, Column]]) -> Step:
    return lambda df: add_columns(df, columns())


def drop(names: Iterable[str]) -> Step:
    return lambda df: drop_columns(df, *names)


def rename(names: Mapping[str, str]) -> Step:
    return lambda df: rename_columns(df, names)


def select(names: Iterable[str]) -> Step:
    return lambda df: select_columns(df, names)


@dataclass(frozen=True)
class RecordStep:
    """A step that only needs the flat columns ``inputs``.

    Where all of them are scalars of the record it runs before the explode,
    once per record; where one sits inside an array it runs after it.
    """

    inputs: tuple[str, ...]
    step: Step


def derive_per_record(inputs: Iterable[str], columns: Callable[[], Mapping[str, Column]]) -> RecordStep:
    return RecordStep(tuple(inputs), derive(columns))


@dataclass(frozen=True)
class LookupSpec:
    """Columns to take from the gold table of another topic.

    Gold tables repeat a record's own columns once per unpacked row, so copies
    are folded before the join unless ``fold_copies`` says otherwise. ``salts``
    splits hot keys where adaptive execution is off; ``hot_keys`` names them, which saves the
    job that finds them (a read of all hits).
    """

    topic: str
    left_key: str
    right_key: str
    take: Mapping[str, str]
    fold_copies: bool = True
    salts: int = 1
    hot_keys: tuple | None = None


@dataclass(frozen=True)
class TopicSpec:
    name: str
    row_steps: tuple[Step, ...]
    record_steps: tuple[RecordStep, ...] = ()
    lookups: tuple[LookupSpec, ...] = ()
    # Flat names that records are expected to have; a run reports those that none has.
    names: tuple[str, ...] = ()
    # Flat names of the scalar fields the steps use, for a topic with a fixed
    # column list; None where unnamed fields pass through.
    reads: tuple[str, ...] | None = None
