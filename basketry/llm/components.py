"""Connected components of a graph given by its links, as DataFrame joins.

Every node starts with the smallest name among itself and its neighbours. A round takes the smallest label among the
neighbours and then the label of that label (pointer jumping), so chains halve in length each time. Rounds end when no
label changes. Each round is written to the shared folder, which cuts the lineage; hubs are aggregated before they are
shuffled, and nothing is collected but whether a label changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import let_go, materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that has a link; a component is named by its smallest node. Links with a null
    end, or from a node to itself, don't count."""
    there = links.select(F.col(a).alias("node"), F.col(b).alias("other")).where(F.col("node") != F.col("other"))
    both = there.unionByName(there.select(F.col("other").alias("node"), F.col("node").alias("other")))
    both = materialize(both.distinct(), "links")
    written = labels = materialize(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    while True:
        theirs = labels.select(F.col("node").alias("other"), F.col("label").alias("theirs"))
        least = both.join(theirs, "other").groupBy("node").agg(F.min("theirs").alias("theirs"))
        step = labels.join(least, "node").select("node", F.col("label").alias("old"), F.least("label", "theirs").alias("label"))
        target = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        step = materialize(step.join(target, "label").select("node", "old", F.least("label", "jump").alias("label")), "labels")
        let_go(written)
        written, labels = step, step.select("node", "label")
        if step.where(F.col("label") != F.col("old")).isEmpty():
            let_go(both)
            return labels.withColumnRenamed("label", "component")


def settled(runs: DataFrame, links: DataFrame, checked: Callable[[DataFrame], DataFrame], undecided: Callable[[DataFrame], DataFrame], draws: int = 2) -> DataFrame:
    """``(node, component)`` when no run ``(run, name)`` holds an unchecked pair of different components that may link.

    ``links`` are those of each run's first member with the others. Members that are still apart are compared with a drawn
    member of the largest component of their run, ``draws`` times, and then pair by pair: ``undecided`` gives, from
    ``(run, name, component)``, the pairs ``(a, b)`` of different components that its filters leave, ``checked`` those that link.
    """
    groups = components(links)
    for draw in range(draws + 1):
        labelled = runs.join(groups.withColumnRenamed("node", "name"), "name", "left").withColumn("component", F.coalesce("component", "name"))
        several = labelled.groupBy("run").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("run")
        apart = materialize(labelled.join(several, "run").select("run", "name", "component"), "runs-apart")
        if apart.isEmpty():
            break
        runs = apart.select("run", "name")
        if draw < draws:
            drawn = F.xxhash64("name", F.lit(draw))
            per = apart.groupBy("run", "component").agg(F.count("*").alias("n"), F.min(F.struct(drawn.alias("d"), "name")).alias("drawn"))
            largest = per.groupBy("run").agg(F.max(F.struct("n", "component", "drawn")).alias("m"))
            largest = largest.select("run", F.col("m.component").alias("largest"), F.col("m.drawn.name").alias("a"))
            tried = apart.join(largest, "run").where(F.col("component") != F.col("largest")).select("a", F.col("name").alias("b"))
        else:
            tried = undecided(apart)
        pairs = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = materialize(links.unionByName(checked(materialize(pairs, "pairs-apart"))).distinct(), "links-apart")
        groups = components(links)
    return groups
