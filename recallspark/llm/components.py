"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recallspark.session import checkpoint

#: Nodes whose sets a task holds before it starts anew (keeping more edges than it must, never fewer).
NODES = 1_000_000


def forest(edges: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect what ``edges`` do: each task leaves out those that close a circle among its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent.get(x, top)
            return top

        for batch in batches:
            if len(parent) > NODES:
                parent.clear()
            kept = []
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one, two = root(x), root(y)
                kept.append(one != two)
                if one != two:
                    parent[two] = one
            yield batch.filter(pa.array(kept, pa.bool_()))

    return edges.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, label`` of every node in ``edges``: the smallest id that it is connected with.

    Each round takes the smallest label among the neighbours, then the label of that label
    (pointer jumping), until nothing changes. Rounds are cut by reliable checkpoints; only a count
    comes to the driver. A family whose members all link with the same few is thinned first: with all links of
    a member in one task, by either end, little more than one link a member is left.
    """
    pairs = edges.select(F.least(a, b).cast("long").alias("a"), F.greatest(a, b).cast("long").alias("b")).filter("a <> b").distinct()
    thin = forest(forest(pairs.repartition("b")).repartition("a"))
    both = thin.select(F.col("a").alias("id"), F.col("b").alias("other"))
    both = checkpoint(both.unionByName(both.select(F.col("other").alias("id"), F.col("id").alias("other"))).filter("id <> other").distinct())
    labels = checkpoint(both.groupBy("id").agg(F.least("id", F.min("other")).alias("label")))
    while True:
        near = (both.join(labels.select(F.col("id").alias("other"), F.col("label").alias("near")), "other")
                .groupBy("id").agg(F.min("near").alias("near")))
        lower = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("new"))
        lower = checkpoint(lower)
        jump = lower.select(F.col("id").alias("new"), F.col("new").alias("far"))
        step = checkpoint(lower.join(jump, "new", "left")
                          .select("id", F.least("new", F.coalesce("far", "new")).alias("new"), F.col("label").alias("old")))
        labels = step.select("id", F.col("new").alias("label"))
        if not step.filter("new <> old").limit(1).count():
            return labels
