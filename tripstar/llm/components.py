"""Connected components of a link table, by label propagation with shortcuts.

Labels live in written tables, never on the driver.  Every round takes the
smallest label over the links of a node and then follows the label's own label,
so the number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once in the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); the label is the
    smallest node that can be reached."""
    both = links.select("a", "b").where("a <> b").distinct()
    both = written(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy("a").agg(F.min("b").alias("low"))
                         .select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                    .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = written(step.join(jump, "label", "left")
                          .select("node", "old", F.least("label", F.coalesce("up", "label")).alias("label")), "labels")
        if new.where("old <> label").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
