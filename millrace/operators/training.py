"""Labelled pairs and deterministic stratified splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = "42"
#: Rows are dealt over so many cells by the start of their hash before any are ranked.
_HEX = 3


def training_pairs(candidates: DataFrame, truth: DataFrame, references: DataFrame, targets: DataFrame) -> DataFrame:
    """``s1_id, t_id, label``: candidates and the true pairs of the given records, each once; label 1 if true."""
    s = references.select(F.col("entity_id").alias("s1_id"))
    t = targets.select(F.col("entity_id").alias("t_id"))
    known = truth.select("s1_id", "t_id").join(s, "s1_id", "left_semi").join(t, "t_id", "left_semi").withColumn("label", F.lit(1))
    both = candidates.select("s1_id", "t_id", F.lit(0).alias("label")).unionByName(known)
    truth_flag = truth.select("s1_id", "t_id", F.lit(1).alias("true")).distinct()
    once = both.groupBy("s1_id", "t_id").agg(F.max("label").alias("label")).join(truth_flag, ["s1_id", "t_id"], "left")
    return once.select("s1_id", "t_id", F.greatest("label", F.coalesce("true", F.lit(0))).alias("label"))


def _hashed(rows: DataFrame, key: Column) -> DataFrame:
    return rows.withColumn("__h", F.md5(F.concat(F.lit(SEED), key).cast("binary"))).withColumn("__cell", F.substring("__h", 1, _HEX))


def _cells(hashed: DataFrame, stratum: str) -> DataFrame:
    """Rows of each cell (by the hash's first digits), and up to it: at most 4,096 rows for each stratum."""
    cells = hashed.groupBy(stratum, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy(stratum).orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0)
    return cells.withColumns({"__upto": F.sum("__n").over(upto), "__all": F.sum("__n").over(Window.partitionBy(stratum))})


def _last_taken(hashed: DataFrame, stratum: str, key: Column, cells: DataFrame) -> DataFrame:
    """``__stratum, __last``: the largest (hash, key) of the first ``n_take`` rows of each stratum, null if all are taken.

    A stratum may hold most of the rows, so it is not ranked as a whole: only rows of the cell in which the quota runs
    out are.
    """
    before = F.col("__upto") - F.col("__n")
    cut = cells.filter((F.col("n_take") > before) & (F.col("n_take") <= F.col("__upto")))
    cut = cut.select(F.col(stratum).alias("__c_stratum"), F.col("__cell").alias("__c_cell"), (F.col("n_take") - before).alias("__left"))
    inside = hashed.join(F.broadcast(cut), (F.col(stratum) == F.col("__c_stratum")) & (F.col("__cell") == F.col("__c_cell")))
    order = Window.partitionBy(stratum).orderBy("__h", "__key")
    ranked = inside.withColumn("__key", key).withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= F.col("__left"))
    last = ranked.groupBy(F.col(stratum).alias("__l_stratum")).agg(F.max(F.struct("__h", "__key")).alias("__last"))
    wanted = cells.filter("n_take > 0").select(F.col(stratum).alias("__stratum")).distinct()
    return wanted.join(last, F.col("__stratum") == F.col("__l_stratum"), "left").select("__stratum", "__last")


def take_by_hash(rows: DataFrame, stratum: str, key: Column, quota: DataFrame) -> DataFrame:
    """Of each stratum the ``quota`` (stratum, ``n_take``) rows of the smallest MD5 of the key, exactly."""
    hashed = _hashed(rows, key)
    last = _last_taken(hashed, stratum, key, _cells(hashed, stratum).join(F.broadcast(quota), stratum))  # a row for each stratum
    taken = F.col("__last").isNull() | (F.struct(F.col("__h"), key.alias("__key")) <= F.col("__last"))
    return hashed.join(F.broadcast(last), F.col(stratum) == F.col("__stratum")).filter(taken).select(rows.columns)


def split_pairs(pairs: DataFrame, share: float = 0.15) -> DataFrame:
    """``pairs`` with ``fold``: ``valid`` for ``share`` of each label (rounded up), ``train`` for the rest.

    Pairs are hashed where they are and never shuffled: what moves are the counts of cells and the rows of one cell for
    each label.
    """
    key = F.concat_ws("|", "s1_id", "t_id")
    hashed = _hashed(pairs, key)
    cells = _cells(hashed, "label").withColumn("n_take", F.ceil(F.col("__all") * F.lit(share)))
    last = F.broadcast(_last_taken(hashed, "label", key, cells))  # a row for each label
    taken = F.col("__last").isNull() | (F.struct(F.col("__h"), key.alias("__key")) <= F.col("__last"))
    folds = hashed.join(last, F.col("label") == F.col("__stratum"), "left")
    return folds.select(*pairs.columns, F.when(F.col("__stratum").isNotNull() & taken, "valid").otherwise("train").alias("fold"))


def stratified_holdout(records: DataFrame, stratum: str, id_col: str, size: int) -> DataFrame:
    """``size`` rows with the strata in proportion: largest remainders, ties to the smaller stratum."""
    counts = records.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    one = Window.partitionBy(F.lit(0))  # over a row per stratum
    exact = counts.withColumn("exact", F.col("n") * F.lit(size) / F.sum("n").over(one)).withColumn("base", F.floor("exact"))
    exact = exact.withColumns({"rest": F.lit(size) - F.sum("base").over(one), "place": F.row_number().over(one.orderBy(F.desc(F.col("exact") - F.col("base")), stratum))})
    quota = exact.select(stratum, (F.col("base") + F.when(F.col("place") <= F.col("rest"), 1).otherwise(0)).alias("n_take"))
    return take_by_hash(records, stratum, F.col(id_col), quota)
