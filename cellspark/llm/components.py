"""Connected components of a link table, by repeated contraction.

Every round each node takes the neighbour of least random priority, if that is below its own, as its
representative; links are carried over to representatives and those inside one are dropped. With fresh
priorities every round the nodes that still have links fall by a constant factor, whatever the shape of
the component, so the rounds grow as the logarithm of its size. A hub costs nothing extra: its links are
reduced to one minimum before they move. Tables are stored between rounds in the shared folder, so a lost
executor costs one round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.functions.lineage import store


class Forest:
    """Union of numbered nodes inside one task."""

    def __init__(self, nodes: int):
        self.parent = np.arange(nodes)

    def link(self, u: np.ndarray, v: np.ndarray) -> None:
        """Join the trees of every pair u[i], v[i]."""
        parent = self.parent
        while True:
            while not np.array_equal(up := parent[parent], parent):
                parent[:] = up
            pu, pv = parent[u], parent[v]
            apart = pu != pv
            if not apart.any():
                return
            u, v, pu, pv = u[apart], v[apart], pu[apart], pv[apart]
            np.minimum.at(parent, np.maximum(pu, pv), np.minimum(pu, pv))

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(node, root) of every node that is not a root: at most one link a node."""
        linked = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return linked, self.parent[linked]


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) of every node in ``links`` (src, dst: long); component is the smallest id reachable.

    Links without a src or dst are left out; loops and repeated links change nothing; no links, no rows.
    """
    valid = links.select("src", "dst").dropna()
    left = store(valid.where("src < dst").union(valid.where("src > dst").select("dst", "src")).distinct())
    label = None
    salt = 0
    while not left.isEmpty():
        salt += 1

        def priority(node: str, salt: int = salt) -> Column:
            return F.xxhash64(F.lit(salt), node)

        near = (
            left.union(left.select("dst", "src"))
            .toDF("id", "near")
            .groupBy("id")
            .agg(F.min(priority("near")).alias("least"), F.min_by("near", priority("near")).alias("near"))
        )
        rep = store(near.select("id", F.when(F.col("least") < priority("id"), F.col("near")).otherwise(F.col("id")).alias("rep")))
        a, b = F.least("a.rep", "b.rep"), F.greatest("a.rep", "b.rep")
        left = store(
            left.join(rep.alias("a"), F.col("src") == F.col("a.id"))
            .join(rep.alias("b"), F.col("dst") == F.col("b.id"))
            .where(F.col("a.rep") != F.col("b.rep"))
            .select(a.alias("src"), b.alias("dst"))
            .distinct()
        )
        if label is None:
            label = rep
        else:
            step = rep.toDF("at", "next")
            label = store(
                label.join(step, F.col("rep") == F.col("at"), "left").select(
                    "id", F.coalesce("next", "rep").alias("rep")
                )
            )
    if label is None:
        return valid.select(F.col("src").alias("id"), F.col("dst").alias("component")).where(F.lit(False))
    least = label.groupBy("rep").agg(F.min("id").alias("component"))
    return label.join(least, "rep").select("id", "component")
