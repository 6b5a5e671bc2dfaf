"""Connected components of a graph given as edges, as Spark joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.session import written


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable, for every node that has an edge.

    `edges` has two long columns `a` and `b`; nulls are left out. In each round a node goes
    to its least neighbour, if that is smaller, and on to where that one goes, by doubling
    steps, until a node without a smaller neighbour is reached. Edges are then drawn between
    those nodes alone, at most half as many as before, and the rounds end with the last edge.
    Every step is written to the shared folder.
    """
    given = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    given = given.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rounds: list[DataFrame] = []
    left = written(given.distinct(), "edges")
    while not rounds or not left.isEmpty():
        roots = _roots(written(left.groupBy("b").agg(F.min("a").alias("root")).toDF("node", "root"), "least"))
        rounds.append(roots)
        of_a = roots.toDF("a", "root_a")
        of_b = roots.toDF("b", "root_b")
        moved = left.join(of_b, "b").join(of_a, "a", "left").select(F.coalesce("root_a", "a").alias("a"), F.col("root_b").alias("b"))
        moved = moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        left = written(moved.distinct(), "edges")
    labels = rounds[-1]
    for earlier in reversed(rounds[:-1]):
        above = labels.toDF("root", "top")
        labels = earlier.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root")).unionByName(labels)
    labels = written(labels.select("node", F.col("root").alias("component")), "labels")
    tops = labels.select(F.col("component").alias("node")).distinct()
    return written(labels.unionByName(tops.select("node", F.col("node").alias("component"))), "components")


def _roots(steps: DataFrame) -> DataFrame:
    """node, root: where the steps (node, root) lead to in the end; a root has no step."""
    while True:
        onward = steps.toDF("root", "further")
        after = written(steps.join(onward, "root", "left").select(
            "node", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        steps = after.select("node", "root")
        if after.where("moved").isEmpty():
            return steps


class Unions:
    """Labels of a task's nodes under merging; arrays, as merges are few and reads many."""

    def __init__(self, n: int, families: np.ndarray | None = None):
        self.label = np.arange(n) if families is None else np.unique(families, return_inverse=True)[1]

    def merge(self, a: int, b: int) -> bool:
        """Whether they were apart."""
        one, other = self.label[a], self.label[b]
        if one == other:
            return False
        self.label[self.label == max(one, other)] = min(one, other)
        return True
