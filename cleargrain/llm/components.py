"""Connected components by contraction, with every step a join of narrow tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleargrain.plans import storage


def _land(frame: DataFrame, purpose: str) -> DataFrame:
    return storage.write_then_read(frame, storage.fresh_folder(frame.sparkSession, purpose))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every end of an edge (``a``, ``b``).

    Each turn a node follows its smallest neighbour, and that one its own; the
    edges between followed nodes form the next, smaller graph. Lineage is cut with
    a written table each turn. Hot nodes meet as partial minima.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct()
    both = _land(both, "edges")
    steps: list[DataFrame] = []
    while not both.isEmpty():
        parent = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("up"))
        above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
        step = _land(parent.join(above, "up").select("node", F.col("top").alias("up")), "followed")
        steps.append(step)
        first = both.join(step, both["a"] == step["node"]).select(F.col("up").alias("a"), "b")
        moved = first.join(step, first["b"] == step["node"]).select("a", F.col("up").alias("b"))
        both = _land(moved.where("a != b").distinct(), "edges")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    out = steps[0].withColumnRenamed("up", "root")
    for step in steps[1:]:
        again = step.select(F.col("node").alias("root"), "up")
        out = out.join(again, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return _land(out, "components")
