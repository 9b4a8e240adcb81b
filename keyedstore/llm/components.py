"""Connected components of links, by least label with pointer jumping.

First every node is set below the least node it is linked from, and only what ties such
least nodes together goes on: many stars around the same few nodes shrink to these nodes.
Then each round every node takes the least label of its neighbours and then its label's
label.  Rounds are written to the shared folder, so lineage stays short.  Labels and
links stay distributed; one count a round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> id, component: the smallest id reachable.  Nodes without links are absent."""
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    below = stored(links.groupBy("b").agg(F.min("a").alias("root")), "roots")
    roots = below.select("root").distinct()
    others = links.join(below, "b").where("a <> root").select("root", F.col("a").alias("id"))
    # a node that is a root itself, and what a node is linked from besides its root
    ties = stored(others.union(below.join(roots.select(F.col("root").alias("b")), "b", "left_semi").select("root", F.col("b").alias("id"))).distinct(), "ties")
    if ties.isEmpty():
        labels = roots.select(F.col("root").alias("id"), F.col("root").alias("component"))
    else:
        tied = spread(ties.select(F.col("root").alias("a"), F.col("id").alias("b")))
        alone = roots.select(F.col("root").alias("id")).join(tied, "id", "left_anti")
        labels = tied.union(alone.select("id", F.col("id").alias("component")))
    own = below.join(labels.select(F.col("id").alias("root"), "component"), "root").select(F.col("b").alias("id"), "component")
    tops = labels.join(below.select(F.col("b").alias("id")), "id", "left_anti")
    return stored(own.union(tops), "components")


def spread(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    held = stored(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("id"), F.least("u", "v").alias("component")), "labels")
    while True:
        labels = held.select("id", "component")
        near = both.join(labels.select(F.col("id").alias("v"), "component"), "v").groupBy("u").agg(F.min("component").alias("near"))
        took = labels.join(near, labels.id == near.u).select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        # only labels whose own label fell in this round lead on; the label of a settled component is none of them
        over = took.where("id = old and component < old").select(F.col("id").alias("component"), F.col("component").alias("next"))
        after = stored(took.join(over, "component", "left").select("id", "old", F.coalesce("next", "component").alias("component")), "labels")
        discard(held)
        held = after
        if not after.where("old <> component").take(1):
            return after.select("id", "component")
