"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) of every node of ``links`` (a, b); the label is the smallest node of its component.

    Every round takes the smallest label among a node and its neighbours, then
    the label of that label, until nothing changes; a star is done in one round. Labels
    stay distributed. The neighbours' labels are aggregated before they are
    shuffled, so a node with very many links is no hot group.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("label")), f"{name}-0")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("m")))
        step = (labels.join(near, labels.node == near.a, "left")
                .select("node", F.least("label", F.coalesce("m", "label")).alias("label"),
                        F.col("label").alias("was")))
        parent = labels.select(F.col("node").alias("p"), F.col("label").alias("up"))
        jumped = stored(step.join(parent, step.label == parent.p, "left")
                        .select("node", F.least("label", F.coalesce("up", "label")).alias("label"), "was"), f"{name}-n")
        labels = jumped.select("node", "label")
        if jumped.filter("label < was").isEmpty():
            return labels
