"""End-to-end plans: inference, re-scoring of saved candidates, training, tuning."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import normalize
from millrace.operators.blocking import MAX_CANDIDATES, MAX_POSTINGS, candidate_lists, generate_candidates, whole_candidates
from millrace.operators.decide import PIPELINE, RESCORE, Thresholds, match_lists, matches
from millrace.operators.features import FUZZY, pair_features, pairs_with_meta, plain_features
from millrace.operators.keys import blocking_keys
from millrace.operators.metrics import blocking_quality, entity_counts, macro_metrics
from millrace.operators.model import BoostedTrees, Scorecard, Scorer
from millrace.operators.training import split_pairs, training_pairs
from millrace.operators.tuning import best_cell, threshold_grid
from millrace.sources.tsv import needed, split_list


@dataclass
class Resolved:
    candidates: DataFrame  # s1_id, candidates
    matched: DataFrame  # s1_id, matched
    scored: DataFrame  # s1_id, t_id, rn, prob
    held: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        """Free what the plan keeps; call it when the results are written."""
        for df in self.held:
            df.unpersist()


def kept(df: DataFrame) -> DataFrame:
    """Normal forms feed the key sizes and both sides of the joins; they are worth keeping."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def score_pairs(pairs: DataFrame, references: DataFrame, targets: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """``pairs`` (any columns) with features and ``prob``. The default scorer needs no edit similarity, so none is computed."""
    scorer = scorer or Scorecard()
    meta = pairs_with_meta(pairs, references, targets)
    if isinstance(scorer, Scorecard):
        return scorer.score(plain_features(meta))
    features = pair_features(meta)
    extra = [c for c in pairs.columns if c not in ("s1_id", "t_id") and c not in FUZZY]
    scored = scorer.score(features)
    return scored.join(pairs.select("s1_id", "t_id", *extra), ["s1_id", "t_id"]) if extra else scored


def resolve(references: DataFrame, targets: DataFrame, scorer: Scorer | None = None, at: Thresholds = PIPELINE, max_postings: int = MAX_POSTINGS, k: int = MAX_CANDIDATES) -> Resolved:
    """All countries in one plan: normalise, block, score, decide. Matches are listed by falling probability."""
    s, t = kept(normalize(references)), kept(normalize(targets))
    candidates = generate_candidates(s, t, max_postings, k)
    scored = score_pairs(candidates, s, t, scorer).select("s1_id", "t_id", "rn", "prob")
    found = matches(scored, at)
    return Resolved(candidate_lists(s, candidates), match_lists(s, found, [-F.col("prob")]), scored, [s, t])


def rescore(saved: DataFrame, references: DataFrame, targets: DataFrame, scorer: Scorer | None = None, at: Thresholds = RESCORE) -> DataFrame:
    """``s1_id, matched`` from saved candidate lists (``source1_entity_id, candidate_entity_ids``), in their order.

    Only targets that some list names are normalised.
    """
    t = normalize(needed(targets, saved_pairs(saved).select(F.col("t_id").alias("entity_id")).distinct()))
    return rescore_normal(saved, normalize(references), t, scorer, at)


def saved_pairs(saved: DataFrame) -> DataFrame:
    """``s1_id, rn, t_id`` of saved lists."""
    return saved.select(F.col("source1_entity_id").alias("s1_id"), F.posexplode(split_list(F.col("candidate_entity_ids"))).alias("rn", "t_id"))


def rescore_normal(saved: DataFrame, references: DataFrame, targets: DataFrame, scorer: Scorer | None = None, at: Thresholds = RESCORE) -> DataFrame:
    """The same for records that are normalised already."""
    scored = score_pairs(saved_pairs(saved), references, targets, scorer).select("s1_id", "t_id", "rn", "prob")
    return match_lists(references, matches(scored, at), [F.col("rn")])


def train(references: DataFrame, targets: DataFrame, truth: DataFrame, rounds: int = 300, **fit: object) -> tuple[BoostedTrees, DataFrame]:
    """A fitted model, whose boosting the validation pairs end, and those pairs with their ``prob`` (kept). The pairs are the
    candidates over all keys, however frequent, and the true ones."""
    s, t = kept(normalize(references)), kept(normalize(targets))
    keys = kept(blocking_keys(s)), kept(blocking_keys(t))
    pairs = kept(training_pairs(whole_candidates(*keys), truth, s, t))
    features = kept(pair_features(pairs_with_meta(pairs, s, t)).join(split_pairs(pairs), ["s1_id", "t_id"]))
    valid = features.filter("fold = 'valid'")
    model = BoostedTrees().fit(features.filter("fold = 'train'"), rounds, valid=valid, **fit)
    scored = kept(model.score(valid))
    scored.count()
    for df in (features, pairs, *keys, s, t):
        df.unpersist()
    return model, scored


def tune(references: DataFrame, truth: DataFrame, scored: DataFrame) -> DataFrame:
    """The best cell of the threshold grid; pairs are scored once."""
    universe = references.select(F.col("entity_id").alias("s1_id"))
    return best_cell(threshold_grid(universe, truth, scored))


def benchmark_blocking(references: DataFrame, targets: DataFrame, truth: DataFrame, rows: int) -> DataFrame:
    """One row of blocking quality over a limited pool: the first ``rows`` targets of each source by id, and the true
    targets that these do not hold."""
    source = F.substring_index("entity_id", "-", 1)
    first = F.row_number().over(Window.partitionBy(source).orderBy("entity_id")) <= rows
    wanted = truth.join(references.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")
    pool = targets.withColumn("__first", first).join(wanted.select(F.col("t_id").alias("entity_id"), F.lit(True).alias("__true")).distinct(), "entity_id", "left")
    pool = pool.filter(F.col("__first") | F.col("__true")).drop("__first", "__true")
    s, t = kept(normalize(references)), kept(normalize(pool))
    size = t.count()
    quality = blocking_quality(s.select(F.col("entity_id").alias("s1_id")), wanted, generate_candidates(s, t), size)
    return quality.withColumn("pool", F.lit(size).cast("long"))


def evaluate(references: DataFrame, truth: DataFrame, matched: DataFrame) -> DataFrame:
    """Macro metrics of match lists."""
    pairs = matched.select("s1_id", F.explode("matched").alias("t_id"))
    return macro_metrics(entity_counts(references.select(F.col("entity_id").alias("s1_id")), truth, pairs))
