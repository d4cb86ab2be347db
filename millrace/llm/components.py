"""Connected components of an edge table, as stored tables: no edge and no component reaches the driver or one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, join_classes, materialize


def _least(edges: DataFrame, total: int) -> DataFrame:
    """Each (u, v) with the least of u and its neighbours. A hub is combined on the map side and joined by broadcast."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return join_classes(edges, least, ["u"], "n", total)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b: any order, repeats and loops allowed).

    The label is the component's least node. Large-star and small-star steps alternate, in a number of rounds
    logarithmic in the longest path; every round is written to the shared scratch folder, so lineage never grows, and
    takes the place of the one before.
    """
    ab = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = materialize(ab, "edges"), None
    while True:
        total, check = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if not total or (total, check) == before:
            break
        before = (total, check)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both, 2 * total).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u <> v").distinct(), "large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        near = _least(down, total)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
        small = materialize(small.filter("u <> v").distinct(), "small")
        discard(edges, large)
        edges = small
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
