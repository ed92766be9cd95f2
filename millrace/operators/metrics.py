"""Evaluation: entity-level F0.5 with singletons, blocking quality, ranking quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Scores are dealt over so many equal bins of [0, 1] when they have to be ranked.
RANK_BINS = 4096


def f05(n_pred: Column, n_true: Column, tp: Column) -> Column:
    """F0.5 of an entity. One without true matches scores 1 if nothing was predicted and 0 otherwise."""
    p, r = tp / n_pred, tp / n_true
    alone = F.when(n_pred == 0, 1.0).otherwise(0.0)
    return F.when(n_true == 0, alone).when((n_pred == 0) | (tp == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def precision(n_pred: Column, n_true: Column, tp: Column) -> Column:
    alone = F.when(n_pred == 0, 1.0).otherwise(0.0)
    return F.when(n_true == 0, alone).when(n_pred == 0, 0.0).otherwise(tp / n_pred)


def recall(n_true: Column, tp: Column) -> Column:
    return F.when(n_true == 0, 1.0).otherwise(tp / n_true)


def entity_counts(universe: DataFrame, truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """``s1_id, n_true, n_pred, tp`` for every entity of ``universe`` (s1_id); pairs of others do not count.

    Both kinds of pairs are flags of one aggregation over their union, a shuffle on the pair and one on the entity.
    """
    flagged = truth.select("s1_id", "t_id", F.lit(1).alias("t"), F.lit(0).alias("p")).unionByName(predicted.select("s1_id", "t_id", F.lit(0).alias("t"), F.lit(1).alias("p")))
    pairs = flagged.groupBy("s1_id", "t_id").agg(F.max("t").alias("t"), F.max("p").alias("p"))
    counts = pairs.groupBy("s1_id").agg(F.sum("t").alias("n_true"), F.sum("p").alias("n_pred"), F.sum(F.col("t") * F.col("p")).alias("tp"))
    return universe.select("s1_id").join(counts, "s1_id", "left").na.fill(0, ["n_true", "n_pred", "tp"])


def entity_scores(counts: DataFrame) -> DataFrame:
    n_pred, n_true, tp = F.col("n_pred"), F.col("n_true"), F.col("tp")
    return counts.withColumns({"f05": f05(n_pred, n_true, tp), "precision": precision(n_pred, n_true, tp), "recall": recall(n_true, tp)})


def macro_metrics(counts: DataFrame) -> DataFrame:
    """One row of averages over entities; 0 without entities, singleton accuracy 1 without singletons."""
    e = entity_scores(counts)
    alone = F.col("n_true") == 0
    return e.agg(
        F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"),
        F.coalesce(F.avg("precision"), F.lit(0.0)).alias("macro_precision"),
        F.coalesce(F.avg("recall"), F.lit(0.0)).alias("macro_recall"),
        F.count(F.lit(1)).alias("n_entities"),
        F.count_if(alone).alias("n_singletons"),
        F.coalesce(F.avg(F.when(alone, (F.col("n_pred") == 0).cast("double"))), F.lit(1.0)).alias("singleton_accuracy"),
    )


def blocking_quality(universe: DataFrame, truth: DataFrame, candidates: DataFrame, n_pool: Column | int) -> DataFrame:
    """One row: pair recall of the candidates, candidates per entity, and the part of all pairs that blocking spared."""
    c = entity_counts(universe, truth, candidates)
    total = c.agg(F.sum("tp").alias("hit"), F.sum("n_true").alias("n_true"), F.sum("n_pred").alias("n_cand"), F.count(F.lit(1)).alias("n"))
    per = F.col("n_cand") / F.col("n")
    return total.select((F.col("hit") / F.greatest(F.lit(1), F.col("n_true"))).alias("recall"), per.alias("avg_candidates"), (1 - per / n_pool).alias("reduction_ratio"))


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """``column``, its count ``n`` and its ``share``. The total is one row that every task gets."""
    n = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("__total"))
    return n.join(F.broadcast(total)).select(column, "n", (F.col("n") / F.col("__total")).alias("share"))


def _binned(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives by bin and score."""
    bin_ = F.least(F.floor(F.col(score) * RANK_BINS), F.lit(RANK_BINS - 1)).cast("int")
    y = F.col(label).cast("int")
    return scored.groupBy(bin_.alias("bin"), F.col(score).alias("score")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def roc_auc(scored: DataFrame, score: str = "prob", label: str = "label") -> DataFrame:
    """One row, ``roc_auc``: exact, ties count half; null unless both labels occur.

    Scores in [0, 1] are ranked within bins, bins among themselves by running
    sums over at most ``RANK_BINS`` rows: no task sees all the scores.
    """
    by_score = _binned(scored, score, label)
    inside = Window.partitionBy("bin").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    pairs = F.col("pos") * (F.coalesce(F.sum("neg").over(inside), F.lit(0)) + F.col("neg") / 2)
    bins = by_score.withColumn("pairs", pairs).groupBy("bin").agg(F.sum("pairs").alias("pairs"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    total = bins.withColumn("below", F.coalesce(F.sum("neg").over(before), F.lit(0)))
    both = F.sum("pos") * F.sum("neg")
    return total.agg(F.when(both > 0, F.sum(F.col("pairs") + F.col("pos") * F.col("below")) / both).alias("roc_auc"))


def average_precision(scored: DataFrame, score: str = "prob", label: str = "label") -> DataFrame:
    """One row, ``average_precision``: the step-wise area under precision and recall, by the same bins."""
    by_score = _binned(scored, score, label)
    bins = by_score.groupBy("bin").agg(F.sum("pos").alias("b_pos"), F.sum("neg").alias("b_neg"))
    above = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("bin", F.coalesce(F.sum("b_pos").over(above), F.lit(0)).alias("a_pos"), F.coalesce(F.sum("b_neg").over(above), F.lit(0)).alias("a_neg"))
    inside = Window.partitionBy("bin").orderBy(F.desc("score"))
    run = by_score.join(F.broadcast(bins), "bin").withColumns({"tp": F.col("a_pos") + F.sum("pos").over(inside), "fp": F.col("a_neg") + F.sum("neg").over(inside)})
    return run.agg(F.when(F.sum("pos") > 0, F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))) / F.sum("pos")).alias("average_precision"))
