"""Connected components of links, by minimum labels and pointer jumping over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import Written


def components(links: DataFrame, written: Written) -> DataFrame:
    """links (a, b) -> (v, label): the least id that each linked id reaches.

    Each round lets every id take the least label of its neighbours and then the label of
    that label, so paths shorten by more than half; rounds go on until none changes.
    Ids that no link names are absent; no links give no rows.
    """
    links = links.filter("a is not null and b is not null and a <> b")
    both = written.save(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written.save(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("v").alias("b"), F.col("label").alias("other")), "b")
            .groupBy(F.col("a").alias("v"))
            .agg(F.min("other").alias("other"))
        )
        took = written.save(
            labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "other").alias("label")),
            "labels",
        )
        jump = took.select(F.col("v").alias("label"), F.col("label").alias("further"))
        new = written.save(took.join(jump, "label", "left").select("v", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        written.drop(labels, took)
        if new.filter("label <> old").isEmpty():
            written.drop(both)
            return new.select("v", "label")
        labels = new
