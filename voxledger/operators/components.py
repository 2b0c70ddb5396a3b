"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxledger.session import shared_checkpoint


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable (``root``) from every ``node`` of ``links`` (``u``, ``v`` of one ordered type).

    Each round links every node to the smallest node it or a neighbour knows, then follows these
    pointers one step further, so paths at least halve. A node with very many neighbours is a partial
    aggregate and an equality join, which adaptive execution splits. Stops when nothing changes.
    """
    links = shared_checkpoint(links.where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    label = shared_checkpoint(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("root")).withColumnRenamed("u", "node"))
    while True:
        root_of = label.select(F.col("node").alias("v"), F.col("root").alias("near"))
        offers = both.join(root_of, "v").groupBy(F.col("u").alias("node")).agg(F.min("near").alias("near"))
        # The least label around a node is offered to the node and to the node's present root.
        met = label.join(offers, "node").select("node", "root", F.least("root", "near").alias("low"))
        to_root = met.groupBy(F.col("root").alias("node")).agg(F.min("low").alias("low"))
        offered = met.select("node", "low").unionByName(to_root).groupBy("node").agg(F.min("low").alias("low"))
        hop = offered.select(F.col("node").alias("low"), F.col("low").alias("up"))
        new = shared_checkpoint(offered.join(hop, "low", "left").select("node", F.coalesce("up", "low").alias("root")))
        changed = new.join(label.withColumnRenamed("root", "before"), "node").where("root != before")
        label = new
        if changed.isEmpty():
            return label
