"""Connected components of a graph given as a table of edges, by rounds of joins.

Each round re-hangs every node's neighbours on the smallest of them, first the
larger neighbours, then the smaller ones, until every component is a star
around its smallest node. Rounds are few (they grow with the logarithm of the
number of nodes); each one is written to the shared folder, so lineage stays
short and no link is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import saved


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
    ).first()
    return row[0], row[1]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of its component.

    Edges are undirected, may repeat and may be loops (a lone loop gives no row);
    edges with a null end are left out. No edges: no rows.
    """
    x, y = F.col(a), F.col(b)
    stars = saved(
        edges.filter(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), "edges"
    )
    before = None
    while (mark := _mark(stars)) != before:
        before = mark
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        stars = saved(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
    roots = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.withColumn("root", F.col("node"))
    )
