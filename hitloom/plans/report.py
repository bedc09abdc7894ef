"""What a run of a topic read and wrote, counted while silver is written, without another pass.

A report is a small table (topic, metric, name, value):

- ``hits``: records that silver was made from; ``rejects``: lines kept apart;
- ``rows``: rows of silver; ``nulls``: how many of them have no value, for each column;
- ``absent``: names that the topic's spec has and no record (0 each).

Tasks that are run again after their executor was lost may count hits twice
where a lookup shuffles them; rows and nulls are counted by the tasks that write.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from hitloom.operators.columns import flat
from hitloom.plans.spec import TopicSpec
from hitloom.sources.hits import case_sensitive

SCHEMA = "topic string, metric string, name string, value long"


def unpacked_names(dtype: DataType, name: str = "") -> Iterator[str]:
    """The flat names that a schema unpacks into."""
    if isinstance(dtype, ArrayType):
        yield from unpacked_names(dtype.elementType, name)
    elif isinstance(dtype, StructType):
        for f in dtype.fields:
            yield from unpacked_names(f.dataType, f"{name}.{f.name}" if name else f.name)
    else:
        yield name


class RunReport:
    """Frames passed through it are counted by the action that runs them."""

    def __init__(self, spec: TopicSpec):
        self.spec = spec
        self.seen: list[tuple[Observation, str, list[str]]] = []
        self.absent: list[str] = []

    def _counted(self, df: DataFrame, metric: str, names: list[str], counts: list[Column]) -> DataFrame:
        observation = Observation()
        self.seen.append((observation, metric, names))
        all_ = F.count(F.lit(1)).alias("all")
        return df.observe(observation, all_, *(c.alias(f"c{k}") for k, c in enumerate(counts)))

    def hits(self, df: DataFrame) -> DataFrame:
        fold = str if case_sensitive(df.sparkSession) else str.lower
        there = set(map(fold, unpacked_names(df.schema)))
        self.absent = sorted(n for n in self.spec.names if fold(n) not in there)
        return self._counted(df, "hits", [], [])

    def rejects(self, df: DataFrame) -> DataFrame:
        return self._counted(df, "rejects", [], [])

    def silver(self, df: DataFrame) -> DataFrame:
        return self._counted(df, "rows", df.columns, [F.count_if(flat(c).isNull()) for c in df.columns])

    def rows(self) -> list[tuple[str, str, str | None, int]]:
        """The report, once the frames have been written."""
        topic, made = self.spec.name, []
        for observation, metric, names in self.seen:
            got = observation.get
            made.append((topic, metric, None, got["all"]))
            made += [(topic, "nulls", name, got[f"c{k}"]) for k, name in enumerate(names)]
        return made + [(topic, "absent", name, 0) for name in self.absent]

    def write(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.rows(), SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
