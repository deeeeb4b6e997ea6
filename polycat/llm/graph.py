"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polycat.llm.common import release, stored


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) for every id in links (a, b).

    Rounds of joins: each id takes the smallest label among its neighbours, then the label of its label, so that long
    chains shrink to half in each round. Labels are written to the shared folder after each round and those of the round
    before deleted; only whether any changed comes to the driver. Minima are taken map-side too, so an id with many
    links is no hot task.
    """
    both = stored(links.where("a <> b").select("a", "b").union(links.where("a <> b").select("b", "a")).distinct())
    last = labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("component")))
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        least = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("step"))
        jump = labels.select(F.col("id").alias("step"), F.col("component").alias("jump"))
        new = stored(least.join(jump, "step", "left").select("id", "old", F.least("step", F.coalesce("jump", "step")).alias("component")))
        release(last)
        last, labels = new, new.select("id", "component")
        if not new.where("old <> component").limit(1).count():
            release(both)
            return labels
