"""From scored pairs to matches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Thresholds:
    """``tau``: the least probability of a match; ``sing``: the least that an entity's best pair must have for it to match anything."""

    tau: float = 0.70
    sing: float = 0.75


# Operating points in use.
DEFAULT = Thresholds(0.70, 0.75)
PIPELINE = Thresholds(0.60, 0.65)
RESCORE = Thresholds(0.55, 0.55)
TUNED = Thresholds(0.55, 0.55)


def matches(scored: DataFrame, at: Thresholds) -> DataFrame:
    """Pairs at or above ``tau`` of entities whose best pair reaches ``sing``."""
    top = F.max("prob").over(Window.partitionBy("s1_id"))
    return scored.withColumn("__top", top).filter((F.col("__top") >= at.sing) & (F.col("prob") >= at.tau)).drop("__top")


def match_lists(references: DataFrame, found: DataFrame, order: list) -> DataFrame:
    """``s1_id, matched`` of every reference: ids in the order of the given (numeric or string) keys, empty where none."""
    keyed = found.select("s1_id", F.struct(*(k.alias(f"k{i}") for i, k in enumerate(order)), "t_id").alias("m"))
    lists = keyed.groupBy("s1_id").agg(F.transform(F.array_sort(F.collect_list("m")), lambda m: m["t_id"]).alias("matched"))
    return references.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left").withColumn("matched", F.coalesce("matched", F.array().cast("array<string>")))
