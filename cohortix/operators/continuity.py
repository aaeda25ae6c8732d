"""Stable identity ids from one revision to the next."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .similarity import dense_rows


def overlaps(labels: DataFrame, previous: DataFrame) -> DataFrame:
    """(label, person_id, shared, least): how many members a new cluster shares with a previous identity; labels (track_id, label), previous (person_id, track_id)."""
    least = labels.groupBy("label").agg(F.min("track_id").alias("least"))
    return labels.join(previous, "track_id").groupBy("label", "person_id").agg(F.count("*").alias("shared")).join(least, "label")


def reconcile(labels: DataFrame, previous: DataFrame, next_number: int = 1) -> DataFrame:
    """(label, person_id): previous ids go one to one to clusters by shared members, id and least member; others get new numbers by least member.

    The greedy choice runs within each connected group of clusters and ids. Ids that are not P and digits end the job;
    ids that nobody keeps are not used again.
    """
    from .clusters import components

    bad = previous.filter(~F.col("person_id").rlike("^P[0-9]+$")).limit(1).collect()
    if bad:
        raise ValueError("a previous id is not P-prefixed digits")
    top = previous.agg(F.max(F.substring("person_id", 2, 18).cast("long")).alias("m")).first()["m"]
    first = max(next_number, (top or 0) + 1)
    shared = overlaps(labels, previous)
    edges = shared.select(F.concat(F.lit("L"), F.col("label").cast("string")).alias("left_id"), F.col("person_id").alias("right_id"))
    nodes = edges.select(F.col("left_id").alias("id")).unionByName(edges.select(F.col("right_id").alias("id"))).distinct()
    groups = components(edges, nodes)
    rows = shared.join(groups, F.concat(F.lit("L"), F.col("label").cast("string")) == F.col("id")).select("component", "label", "person_id", "shared", "least")

    def assign(frame: pd.DataFrame) -> pd.DataFrame:
        taken, given = set(), {}
        for row in frame.sort_values(["shared", "person_id", "least", "label"], ascending=[False, True, True, True]).itertuples(index=False):
            if row.label not in given and row.person_id not in taken:
                given[row.label] = row.person_id
                taken.add(row.person_id)
        return pd.DataFrame(list(given.items()), columns=["label", "person_id"])

    kind = labels.schema["label"].dataType.simpleString()
    kept = rows.groupBy("component").applyInPandas(assign, f"label {kind}, person_id string")
    least = labels.groupBy("label").agg(F.min("track_id").alias("least"))
    fresh = least.join(kept, "label", "left_anti")
    named = dense_rows(fresh, "least").select("label", F.format_string("P%04d", F.col("row") + first).alias("person_id"))
    return kept.unionByName(named)


def lineage(labels: DataFrame, previous: DataFrame) -> DataFrame:
    """(label, previous_ids): all previous identities that share a member with each cluster."""
    shared = labels.join(previous, "track_id").groupBy("label").agg(F.array_sort(F.collect_set("person_id")).alias("previous_ids"))
    return labels.select("label").distinct().join(shared, "label", "left").withColumn("previous_ids", F.coalesce("previous_ids", F.array().cast("array<string>")))


def retired(previous: DataFrame, current: DataFrame) -> DataFrame:
    return previous.select("person_id").distinct().join(current.select("person_id").distinct(), "person_id", "left_anti")
