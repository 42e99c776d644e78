"""Connected components of a table of links, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.shared import stored
from tallyframe.operators.joins import skew_split_join

#: a key of more rows is split, if at most HOT_KEYS keys can have as many
HOT_ROWS, HOT_KEYS = 1000, 10_000


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (columns a and b): the smallest id it reaches.

    Each round takes the least label of the neighbours, then the label of
    that label, so paths shorten by half; it ends when no label changes.
    Labels stay in tables in the shared folder, only counts reach the driver.
    A node with very many links is reduced map-side (least label) where it
    receives; where it sends, and where very many nodes have one label to
    follow, the rows of that key are dealt over several tasks.
    """
    links = links.where("a <> b")
    edges = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    hot = max(HOT_ROWS, -(-edges.count() // HOT_KEYS))
    hubs = stored(edges.groupBy("b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot)
                  .select("b", F.ceil(F.col("n") / hot).cast("int").alias("parts")))
    if hubs.limit(1).count():
        one = F.coalesce("parts", F.lit(1))
        edges = stored(edges.join(F.broadcast(hubs), "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), one).cast("int").alias("part")))

        def sent(labels: DataFrame) -> DataFrame:
            told = labels.select(F.col("id").alias("b"), "label").join(F.broadcast(hubs), "b", "left")
            return edges.join(told.select("b", "label", F.explode(F.sequence(F.lit(0), one - 1)).alias("part")), ["b", "part"])
    else:
        def sent(labels: DataFrame) -> DataFrame:
            return edges.join(labels.select(F.col("id").alias("b"), "label"), "b")

    labels = edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("label"))
    while True:
        labels = stored(labels)
        near = sent(labels).groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        step = stored(labels.join(near, "id").select("id", "label", F.least("label", "near").alias("next")))
        jump = labels.select(F.col("id").alias("next"), F.col("label").alias("far"))
        labels = stored(skew_split_join(step, jump, "next", hot_rows=hot).select("id", "label", F.least("next", "far").alias("next")))
        if not labels.where("label <> next").limit(1).count():
            return labels.select("id", F.col("next").alias("component"))
        labels = labels.select("id", F.col("next").alias("label"))
