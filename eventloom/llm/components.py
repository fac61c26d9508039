"""Connected components of a link table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import discard, stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the (a, b) long pairs; component is its smallest node.

    Every round takes the smallest label among a node and its neighbours and then the
    label of that label, so the rounds grow with the logarithm of a path's
    length on most graphs and stars take two. Labels are written between rounds.
    """
    a, b = links.columns
    one = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    ends = one.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")), F.struct("a", F.col("a").alias("b")), F.struct(F.col("b").alias("a"), "b"))).alias("e"))
    both = stage(ends.select("e.a", "e.b").distinct(), "links")  # every node is its own neighbour as well
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")), "labels")
    written = labels
    while True:
        own = F.max(F.when(F.col("a") == F.col("b"), F.col("component")))
        step = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(own.alias("old"), F.min("component").alias("component"))
        hop = labels.select(F.col("node").alias("at"), F.col("component").alias("further"))
        nxt = step.join(hop, step["component"] == hop["at"]).select(F.col("a").alias("node"), "old", F.least("component", "further").alias("component"))
        nxt = stage(nxt, "labels")
        discard(written)
        if nxt.filter("old <> component").isEmpty():
            discard(both)
            return nxt.select("node", "component")
        written, labels = nxt, nxt.select("node", "component")


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after more (a, b) links, from the ``found`` of ``components`` or of this.

    Only the components that the links join are searched again, so what was found before costs
    one join and not its rounds once more.
    """
    a, b = links.columns
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nodes = found.select("node", "component").union(nodes.select("node", F.col("node").alias("component")))
    known = stage(nodes.groupBy("node").agg(F.min("component").alias("component")), "known")
    of = lambda end: known.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
    across = links.join(of("a"), "a").join(of("b"), "b").filter("of_a <> of_b").select("of_a", "of_b").distinct()
    across = stage(across, "across")
    if across.isEmpty():
        discard(across)
        return known
    further = components(across).select(F.col("node").alias("component"), F.col("component").alias("lowest"))
    out = known.join(further, "component", "left").select("node", F.coalesce("lowest", "component").alias("component"))
    out = stage(out, "merged")
    discard(across)
    discard(known)
    return out
