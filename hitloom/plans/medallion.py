"""From exported hits to silver and gold tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from hitloom.operators.columns import select_columns
from hitloom.operators.lookup import lookup_left_join
from hitloom.operators.nested import array_columns, unpack
from hitloom.plans.contract import BRONZE, GOLD, REJECTS, REPORT, SILVER
from hitloom.plans.report import RunReport
from hitloom.plans.spec import LookupSpec, RecordStep, Step, TopicSpec
from hitloom.plans.topics import TOPICS
from hitloom.sources.hits import BRONZE_FILES, case_sensitive, land_bronze, narrow_schema, read_hits, split_rejects, write_bronze
from hitloom.sources.tables import layer_path, read_table, write_table


def _lookup_step(lookup: LookupSpec, tables: Mapping[str, DataFrame]) -> RecordStep:
    def join(df: DataFrame) -> DataFrame:
        return lookup_left_join(
            df,
            tables[lookup.topic],
            lookup.left_key,
            lookup.right_key,
            lookup.take,
            salts=lookup.salts,
            fold_copies=lookup.fold_copies,
            hot_keys=lookup.hot_keys,
        )

    return RecordStep((lookup.left_key,), join)


def curate(
    hits: DataFrame,
    spec: TopicSpec,
    lookups: Mapping[str, DataFrame] | None = None,
    drop_first: Iterable[str] = (),
    spread: int | None = None,
) -> DataFrame:
    """The silver rows of a topic, lazily: unpack the hits and run the spec.

    ``lookups`` maps topic names to their gold tables. A lookup is a record
    step: hits are matched (and, beyond broadcast size, shuffled) once and not
    once per exploded row. ``drop_first`` and ``spread`` are those of
    :func:`~hitloom.operators.nested.unpack`.
    """
    record_steps = (*(_lookup_step(one, lookups or {}) for one in spec.lookups), *spec.record_steps)
    waiting: list[Step] = []
    added: list[str] = []

    fold = str if case_sensitive(hits.sparkSession) else str.lower

    def per_record(df: DataFrame) -> DataFrame:
        scalars = {fold(c) for c in set(df.columns) - set(array_columns(df))}
        before = set(df.columns)
        for record_step in record_steps:
            if scalars.issuperset(map(fold, record_step.inputs)):
                df = record_step.step(df)
            else:
                waiting.append(record_step.step)
        added.extend(name for name in df.columns if name not in before)
        return df

    rows = unpack(hits, drop_first, per_record, spread)
    # Derived columns follow the unpacked ones, whenever they were made.
    rows = select_columns(rows, [c for c in rows.columns if c not in added] + added)
    return reduce(lambda df, step: step(df), (*waiting, *spec.row_steps), rows)


def run_topic(
    spark: SparkSession,
    spec: TopicSpec,
    root: str,
    export: str | list[str] | DataFrame | None = None,
    layout: str = "lines",
    indent: int = 4,
    schema: StructType | str | None = None,
    fmt: str = "parquet",
    gold_fn: Callable[[DataFrame], DataFrame] | None = None,
    drop_first: Iterable[str] = (),
    spread: int | None = None,
    prefix: str = "",
    bronze_options: Mapping[str, str] | None = None,
    rejects: bool = False,
    mixed_arrays: bool = False,
    gold_from: str = "silver",
    schema_change: str = "refuse",
    bronze_files: Mapping[str, str] = BRONZE_FILES,
    **write_options: str,
) -> DataFrame:
    """Run one topic and return its gold table.

    With ``export`` (files in a ``layout`` of :func:`land_bronze`, or hits that
    some other reader gives), its hits replace the topic's bronze layer first.
    Silver is computed once; gold is made from the written silver table, by
    ``gold_fn`` where given and else as a plain copy.

    Bronze is written compressed; ``bronze_files`` are its write options (``{}``: plain text).

    ``prefix`` goes before every topic name in paths. ``bronze_options`` are
    for reading a bronze layer that something else has written, such as
    ``{"multiLine": "true"}`` for one JSON array per file.

    Bronze lines that are no hits fail the run. With ``rejects`` they are
    written to the topic's ``rejects`` layer instead, as they are, one per line,
    and the topic is made from the others.

    ``mixed_arrays`` is that of :func:`~hitloom.sources.hits.read_hits`: fields that only some
    hits hold an array in are exploded too.

    ``gold_from="hits"`` gives ``gold_fn`` the nested hits instead of silver's rows, for
    :func:`~hitloom.operators.siblings.aggregate_unpacked`. ``schema_change`` says what may
    replace layers of an earlier run, see :func:`~hitloom.sources.tables.write_table`.

    What went in and out is counted while silver is written, without another pass, and is the
    topic's ``report`` layer: see :mod:`hitloom.plans.report`.
    """
    if gold_from not in ("silver", "hits"):
        raise ValueError(f"gold_from {gold_from!r}: expected 'silver' or 'hits'")
    if mixed_arrays and (rejects or bronze_options or schema is not None):
        raise ValueError("mixed_arrays goes without rejects, bronze_options and schema")

    def path(topic: str, layer: str) -> str:
        return layer_path(root, prefix + topic, layer)

    bronze, silver, gold = (path(spec.name, layer) for layer in (BRONZE, SILVER, GOLD))
    options = dict(bronze_options or {})
    if isinstance(export, DataFrame):
        schema = schema or (None if mixed_arrays else export.schema)
        write_bronze(export, bronze, **{"compression": "none", "maxRecordsPerFile": "0", **bronze_files})
    elif export is not None:
        land_bronze(spark, export, bronze, layout, indent, **bronze_files)
    report = RunReport(spec)
    if rejects:
        hits, bad = split_rejects(spark, bronze, schema)
        report.rejects(bad).write.mode("overwrite").text(path(spec.name, REJECTS))
    elif mixed_arrays:
        hits = read_hits(spark, bronze, mixed_arrays=True)
    else:
        hits = read_hits(spark, bronze, schema=schema, **options)
        if spec.reads is not None:
            narrowed = narrow_schema(hits.schema, spec.reads, case_sensitive(spark))
            hits = read_hits(spark, bronze, schema=narrowed, **options)
    lookups = {
        lookup.topic: read_table(spark, path(lookup.topic, GOLD), fmt) for lookup in spec.lookups
    }
    silver_rows = report.silver(curate(report.hits(hits), spec, lookups, drop_first, spread))
    write_table(silver_rows, silver, fmt, schema_change, **write_options)
    report.write(spark, path(spec.name, REPORT))
    made = hits if gold_from == "hits" else read_table(spark, silver, fmt)
    write_table(gold_fn(made) if gold_fn else made, gold, fmt, schema_change, **write_options)
    return read_table(spark, gold, fmt)


def run_topics(
    spark: SparkSession,
    exports: Mapping[str, str | list[str] | DataFrame],
    root: str,
    topic_options: Mapping[str, Mapping] | None = None,
    side_by_side: int = 4,
    **options,
) -> dict[str, DataFrame]:
    """Run the topics that have an export, lookups before those who need them.

    ``options`` are those of :func:`run_topic` for all topics; ``topic_options``
    maps a topic to its own, such as its ``schema`` or ``gold_fn``, which win.
    Topics that do not wait for each other run side by side, as many as
    ``side_by_side`` at a time.
    """
    own = topic_options or {}
    if unknown := sorted((set(exports) | set(own)) - set(TOPICS)):
        raise ValueError(f"unknown topics: {', '.join(unknown)}")
    made: dict[str, DataFrame] = {}

    def run(name: str) -> DataFrame:
        return run_topic(spark, TOPICS[name], root, exports[name], **{**options, **own.get(name, {})})

    waiting = [name for name in TOPICS if name in exports]
    while waiting:
        ready = [name for name in waiting if not {one.topic for one in TOPICS[name].lookups} & set(waiting)]
        with ThreadPoolExecutor(max_workers=min(side_by_side, len(ready))) as pool:
            made.update(zip(ready, pool.map(inheritable_thread_target(run), ready)))
        waiting = [name for name in waiting if name not in made]
    return {name: made[name] for name in TOPICS if name in made}
