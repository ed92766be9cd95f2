"""Candidate generation: a weighted equi-join on blocking keys.

There is no index to build and no loop over countries: keys of targets and
references meet in one shuffle on (country, key). Keys that too many targets
share are dropped before the join, which also bounds what a key can make of a
reference, and the top candidates are taken with a window that Spark limits
before it shuffles. Without a cap (:func:`whole_candidates`) frequent keys count
like all others, but records with the same frequent keys meet as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keys import KINDS, blocking_keys

MAX_POSTINGS = 300
MAX_CANDIDATES = 15


def union_targets(*sources: DataFrame) -> DataFrame:
    out = sources[0]
    for more in sources[1:]:
        out = out.unionByName(more)
    return out


def key_sizes(target_keys: DataFrame) -> DataFrame:
    return target_keys.groupBy("country", "key").agg(F.count(F.lit(1)).alias("n"))


def hot_keys(target_keys: DataFrame, max_postings: int = MAX_POSTINGS) -> DataFrame:
    """Keys that more than ``max_postings`` targets have: ``country, key, n``."""
    return key_sizes(target_keys).filter(F.col("n") > max_postings)


def capped_postings(target_keys: DataFrame, max_postings: int = MAX_POSTINGS) -> DataFrame:
    """Postings of the keys at or under the cap. The hot keys are few, whatever the postings; a left-anti join drops them."""
    return target_keys.join(hot_keys(target_keys, max_postings).select("country", "key"), ["country", "key"], "left_anti")


def candidate_scores(reference_keys: DataFrame, target_keys: DataFrame, max_postings: int = MAX_POSTINGS) -> DataFrame:
    """``s1_id, t_id, score``: the weights of the keys that a reference and a target share, added up.

    Hits are dealt by reference alone, which serves the sum over pairs and the
    top-K after it: a pair shares few keys, so summing before the shuffle would
    save little, and the cap bounds what one reference brings together.
    """
    t = capped_postings(target_keys, max_postings).select("country", "key", F.col("entity_id").alias("t_id"))
    s = reference_keys.select("country", "key", F.col("entity_id").alias("s1_id"), "weight")
    return s.join(t, ["country", "key"]).select("s1_id", "t_id", "weight").repartition("s1_id").groupBy("s1_id", "t_id").agg(F.sum("weight").alias("score"))


def top_candidates(scores: DataFrame, k: int = MAX_CANDIDATES) -> DataFrame:
    """The ``k`` best of each reference with their rank ``rn``; equal scores go by target id."""
    best = Window.partitionBy("s1_id").orderBy(F.desc("score"), "t_id")
    return scores.withColumn("rn", F.row_number().over(best)).filter(F.col("rn") <= k)


def _frequent(keys: DataFrame, hot: DataFrame) -> DataFrame:
    """``country, id, hot``: the frequent keys of each record that has any, with their weights, in order."""
    own = keys.join(hot, ["country", "key"], "left_semi").groupBy("country", F.col("entity_id").alias("id"))
    return own.agg(F.array_sort(F.collect_list(F.struct("key", "weight"))).alias("hot"))


def _with_frequent(keys: DataFrame, frequent: DataFrame, name: str) -> DataFrame:
    own = frequent.select(F.col("id").alias("entity_id"), F.col("hot").alias(f"{name}_hot"))
    return keys.join(own, "entity_id", "left").withColumnRenamed("entity_id", f"{name}_id")


def _by_rare_keys(reference_keys: DataFrame, target_keys: DataFrame, hot: DataFrame, s_hot: DataFrame, t_hot: DataFrame) -> DataFrame:
    """``s1_id, t_id, score`` of the pairs that share a key other than ``hot``; their frequent keys count in the score."""
    s = _with_frequent(reference_keys, s_hot, "s1")
    t = _with_frequent(target_keys.join(hot, ["country", "key"], "left_anti").drop("weight"), t_hot, "t")
    both = F.aggregate(F.array_intersect("s1_hot", "t_hot"), F.lit(0.0), lambda total, key: total + key["weight"])
    hits = s.join(t, ["country", "key"]).select("s1_id", "t_id", "weight", F.coalesce(both, F.lit(0.0)).alias("both"))
    return hits.repartition("s1_id").groupBy("s1_id", "t_id").agg((F.sum("weight") + F.max("both")).alias("score"))


def _by_frequent_keys(s_hot: DataFrame, t_hot: DataFrame, k: int) -> DataFrame:
    """``s1_id, t_id, score``: for each reference the ``k`` best targets by their shared frequent keys alone.

    Records of the same frequent keys are one class, named by its smallest id. The ``k`` best classes by score, then by
    that id, hold the ``k`` best targets, and of each class only the ``k`` smallest ids can be among them.
    """
    of_class = Window.partitionBy("country", "hot")
    s = s_hot.withColumn("s_class", F.min("id").over(of_class))
    t = t_hot.withColumn("place", F.row_number().over(of_class.orderBy("id"))).filter(F.col("place") <= k)
    t = t.groupBy("country", "hot").agg(F.array_sort(F.collect_list("id")).alias("t_ids"))
    each = lambda df, *c: df.select("country", F.inline("hot"), *c)
    s_keys = each(s.filter("id = s_class"), "s_class")
    t_keys = each(t, F.col("t_ids")[0].alias("t_class")).drop("weight")
    shared = s_keys.join(t_keys, ["country", "key"]).select("s_class", "t_class", "weight").repartition("s_class")
    best = Window.partitionBy("s_class").orderBy(F.desc("score"), "t_class")
    classes = shared.groupBy("s_class", "t_class").agg(F.sum("weight").alias("score")).withColumn("rn", F.row_number().over(best)).filter(F.col("rn") <= k)
    members = classes.join(t.select(F.col("t_ids")[0].alias("t_class"), "t_ids"), "t_class").select("s_class", "score", F.explode("t_ids").alias("t_id"))
    top = members.withColumn("rn", F.row_number().over(best.orderBy(F.desc("score"), "t_id"))).filter(F.col("rn") <= k)
    return top.join(s.select("s_class", F.col("id").alias("s1_id")), "s_class").select("s1_id", "t_id", "score")


def whole_candidates(reference_keys: DataFrame, target_keys: DataFrame, k: int = MAX_CANDIDATES, frequent: int = MAX_POSTINGS) -> DataFrame:
    """The ``k`` best of each reference over all keys, as :func:`top_candidates` of scores without a cap gives them.

    Pairs that share a key of at most ``frequent`` targets are made one by one, with their whole score. Of the pairs that
    share more frequent keys only, those by :func:`_by_frequent_keys` are enough: any other has ``k`` before it whose
    whole score is no less. ``frequent`` is where one way hands over to the other; the result does not depend on it.
    """
    hot = hot_keys(target_keys, frequent).select("country", "key")
    s_hot, t_hot = _frequent(reference_keys, hot), _frequent(target_keys, hot)
    rare = top_candidates(_by_rare_keys(reference_keys, target_keys, hot, s_hot, t_hot), k).drop("rn")
    both = rare.unionByName(_by_frequent_keys(s_hot, t_hot, k)).groupBy("s1_id", "t_id").agg(F.max("score").alias("score"))
    return top_candidates(both, k)


def candidate_lists(references: DataFrame, candidates: DataFrame) -> DataFrame:
    """``s1_id, candidates`` (ids by rank) of every reference, empty where it has none."""
    lists = candidates.groupBy("s1_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rn", "t_id"))), lambda x: x["t_id"]).alias("candidates"))
    return references.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left").withColumn("candidates", F.coalesce("candidates", F.array().cast("array<string>")))


def generate_candidates(references: DataFrame, targets: DataFrame, max_postings: int = MAX_POSTINGS, k: int = MAX_CANDIDATES, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """Normalised references and targets to ``s1_id, t_id, score, rn``."""
    return top_candidates(candidate_scores(blocking_keys(references, kinds), blocking_keys(targets, kinds), max_postings), k)
