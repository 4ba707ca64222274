"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportweave.sources.stored import store


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` for every id in a link; the component is its smallest id.

    In every round each node points at its smallest neighbour, pointers are followed twice, and
    nodes are replaced by what they point at. A link between nodes that point at different nodes
    stays, so nothing is lost, and stars, the usual form here, vanish in one round. Every round
    is written to the shared folder. Links with a null end are ignored.
    """
    ends = links.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
    edges = store(ends.where(F.col("u") < F.col("v")).distinct(), "edges")
    labels = store(
        edges.select(F.col("u").alias("id")).union(edges.select("v")).distinct()
        .withColumn("component", F.col("id")),
        "labels",
    )
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        points = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("to"))
        points = store(points, "pointers")
        further = points.select(F.col("u").alias("to"), F.col("to").alias("then"))
        points = store(
            points.join(further, "to").select("u", F.col("then").alias("to")), "pointers"
        )
        of = lambda name: points.select(F.col("u").alias(name), F.col("to").alias(f"new_{name}"))
        labels = store(
            labels.join(of("component"), "component", "left").select(
                "id", F.coalesce("new_component", "component").alias("component")
            ),
            "labels",
        )
        moved = edges.join(of("u"), "u").join(of("v"), "v").select(
            F.least("new_u", "new_v").alias("u"), F.greatest("new_u", "new_v").alias("v")
        )
        edges = store(moved.where(F.col("u") < F.col("v")).distinct(), "edges")
    return labels
