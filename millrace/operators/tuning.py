"""Search for the two thresholds over scored pairs.

Pairs are read once: per entity, seven counts of predictions and of hits, and
the best probability. The grid is then a small table joined to entities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .metrics import f05, precision, recall

# The levels that both thresholds take.
LEVELS = [0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85]

#: Cells whose thresholds lie near enough (in binary floating point, which decides cells at the edge).
GRID = [(sing, tau) for sing in LEVELS for tau in LEVELS if sing - 0.20 <= tau <= sing + 0.15]


def threshold_grid(universe: DataFrame, truth: DataFrame, scored: DataFrame) -> DataFrame:
    """``sing, tau`` and the macro metrics of each cell of the grid."""
    hit = truth.select("s1_id", "t_id", F.lit(True).alias("hit")).distinct()
    flagged = scored.join(hit, ["s1_id", "t_id"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    reach = [F.col("prob") >= tau for tau in LEVELS]
    per = flagged.groupBy("s1_id").agg(F.max("prob").alias("top"), F.array(*(F.count_if(r) for r in reach)).alias("n_pred"), F.array(*(F.count_if(r & F.col("hit")) for r in reach)).alias("tp"))
    n_true = truth.groupBy("s1_id").agg(F.count_distinct("t_id").alias("n_true"))
    entities = universe.select("s1_id").join(n_true, "s1_id", "left").join(per, "s1_id", "left")
    cells = F.array(*(F.struct(F.lit(s).alias("sing"), F.lit(t).alias("tau"), F.lit(LEVELS.index(t) + 1).alias("i")) for s, t in GRID))
    each = entities.select(F.coalesce("n_true", F.lit(0)).alias("n_true"), "top", "n_pred", "tp", F.explode(cells).alias("c"))
    open_ = F.coalesce(F.col("top") >= F.col("c.sing"), F.lit(False))
    at = lambda a: F.when(open_, F.element_at(a, F.col("c.i"))).otherwise(0)
    each = each.select("c.sing", "c.tau", "n_true", at("n_pred").alias("n_pred"), at("tp").alias("tp"))
    n_pred, n_t, tp = F.col("n_pred"), F.col("n_true"), F.col("tp")
    alone = n_t == 0
    return each.groupBy("sing", "tau").agg(
        F.avg(f05(n_pred, n_t, tp)).alias("macro_f05"),
        F.avg(precision(n_pred, n_t, tp)).alias("macro_precision"),
        F.avg(recall(n_t, tp)).alias("macro_recall"),
        F.coalesce(F.avg(F.when(alone, (n_pred == 0).cast("double"))), F.lit(1.0)).alias("singleton_accuracy"),
    )


def best_cell(grid: DataFrame, digits: int = 12) -> DataFrame:
    """The cell of the largest F0.5; of equals the one that comes first in the grid."""
    return grid.orderBy(F.desc(F.round("macro_f05", digits)), "sing", "tau").limit(1)
