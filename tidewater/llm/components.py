"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.tables import keep

# Edges a task unites at a time; bounds its memory.
_FOREST_EDGES = 500_000


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one task: each node it saw with the least one united with it."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def stars() -> pa.RecordBatch:
        pairs = [(root(x), x) for x in parent]
        pairs = [p for p in pairs if p[0] != p[1]]
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    seen = 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        seen += batch.num_rows
        if seen >= _FOREST_EDGES:
            yield stars()
            parent.clear()
            seen = 0
    yield stars()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (a, b: bigint); root is the least node reachable.

    Tasks first unite the edges they hold. Then every round sends each node to the least of
    itself and its neighbours, twice over, and contracts the edges onto what is left, so
    that no node is ever gathered with all its neighbours; minima combine before the shuffle.
    """
    edges = keep(edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).where("a <> b").mapInArrow(_forests, "a bigint, b bigint").distinct())
    labels = keep(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")))
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = keep(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")))
        up = parent.select(F.col("a").alias("p"), F.col("p").alias("q"))
        parent = keep(parent.join(up, "p").select("a", F.col("q").alias("p")))
        labels = keep(
            labels.join(parent.withColumnRenamed("a", "root"), "root", "left").select("node", F.coalesce("p", "root").alias("root"))
        )
        left = parent.select("a", F.col("p").alias("pa"))
        right = parent.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        edges = keep(
            edges.join(left, "a").join(right, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        )
    return labels
