"""Keys, blocking, features, decisions, metrics and splits on hand cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import blocking as B
from millrace.operators import decide, metrics, training, tuning
from millrace.operators import features as X
from millrace.operators.keys import STOPWORDS, blocking_keys, weight_of
from millrace.operators.model import BoostedTrees, Scorecard
from millrace.plans import resolve as R

NORMAL = "country string, entity_id string, name_clean string, name_core string, addr_clean string, postal string"


def records(spark, rows):
    return spark.createDataFrame(rows, NORMAL)


def keys_of(spark, core, addr="", postal=None):
    return {r.key for r in blocking_keys(records(spark, [("US", "x", core, core, addr, postal)])).collect()}


def test_keys_of_the_worked_example(spark):
    assert keys_of(spark, "maure williams colombier", "85 wayne avenue ticonderoga ny 12883", "12883") == {
        "nc:maure williams colombier", "cmp:maurewilliamscolombier", "tok:maure", "tok:williams", "tok:colombier", "p4:will", "p4:colo",
        "pfx2:maure_williams", "addr:85_wayne", "addr:85_avenue", "post:12883_85",
    }


def test_short_and_single_names(spark):
    assert keys_of(spark, "ibm") == set()
    assert keys_of(spark, "tesla") == {"nc:tesla", "cmp:tesla", "tok:tesla", "pfx1:tesla"}
    assert len(STOPWORDS) == len(set(STOPWORDS)) == 42


def test_weights(spark):
    df = spark.createDataFrame([("nc:a",), ("cmp:a",), ("pfx2:a",), ("post:a",), ("addr:a",), ("tok:a",), ("p4:a",), ("pfx1:a",), ("post_str:a",)], "k string")
    assert [r.w for r in df.select(weight_of(F.col("k")).alias("w")).collect()] == [6, 5, 4, 3, 3, 2, 1, 1, 1]


def test_hot_key_and_ties(spark):
    s = records(spark, [("US", "S1-1", "acme", "acme", "", None), ("US", "S1-2", "zzz", "zzz", "", None)])
    t = records(spark, [("US", f"S2-{i:03}", "acme", "acme", "", None) for i in range(20)])
    assert B.generate_candidates(s, t, max_postings=19).count() == 0
    got = B.generate_candidates(s, t, max_postings=20, k=15).orderBy("rn").collect()
    assert [r.t_id for r in got] == [f"S2-{i:03}" for i in range(15)]
    lists = {r.s1_id: r.candidates for r in B.candidate_lists(s, B.generate_candidates(s, t)).collect()}
    assert lists["S1-2"] == [] and len(lists["S1-1"]) == 15


def test_countries_do_not_mix(spark):
    s = records(spark, [("US", "S1-1", "acme", "acme", "", None)])
    t = records(spark, [("India", "S2-1", "acme", "acme", "", None)])
    assert B.generate_candidates(s, t).count() == 0


def features(spark, s, t):
    ref, tar = records(spark, [("US", "S1-1", *s)]), records(spark, [("US", "S2-1", *t)])
    pair = spark.createDataFrame([("S1-1", "S2-1")], "s1_id string, t_id string")
    return X.pair_features(X.pairs_with_meta(pair, ref, tar)).first()


def test_features(spark):
    f = features(spark, ("ab", "ab", "12 oak street", "12345"), ("ab inc", "ab", "12 oak road", "54321"))
    assert (f.name_exact_clean, f.name_exact_core, f.name_compact_match) == (0, 1, 1)
    assert f.name_char3gram_jaccard == 1 and f.name_token_jaccard == 1 and f.number_match == 1
    assert (f.postal_exact_match, f.postal_mismatch) == (0, 1)
    assert f.addr_token_jaccard == 0.5 and f.name_len_diff == 4 and f.source_is_s2 == 1 and f.source_is_s3 == 0
    assert f.name_addr_geom_mean == pytest.approx((f.name_fuzz_token_set * f.addr_fuzz_token_set) ** 0.5)


def test_features_of_missing_parts(spark):
    f = features(spark, ("", "", "", None), ("", "", "", None))
    assert f.name_exact_clean == f.name_char3gram_jaccard == f.name_len_ratio == f.number_match == 0
    assert f.is_s23_addr_missing == 1 and f.is_both_addr_present == 0 and f.name_fuzz_ratio == 1 and f.name_fuzz_token_set == 0
    f = features(spark, ("a", "a", "1 oak", "11111"), ("a", "a", "1 oak", None))
    assert (f.postal_exact_match, f.postal_mismatch) == (0, 0)


def scored(spark, probs):
    return spark.createDataFrame([("S1-1", f"S2-{i}", p) for i, p in enumerate(probs)], "s1_id string, t_id string, prob double")


def test_shield(spark):
    at = decide.PIPELINE
    assert decide.matches(scored(spark, [0.64, 0.61]), at).count() == 0
    assert decide.matches(scored(spark, [0.66, 0.61, 0.59]), at).count() == 2
    assert decide.matches(scored(spark, [0.58]), decide.Thresholds(tau=0.6, sing=0.55)).count() == 0


def macro(spark, truth, predicted, universe):
    pairs = lambda rows: spark.createDataFrame(rows, "s1_id string, t_id string")
    return metrics.macro_metrics(metrics.entity_counts(spark.createDataFrame([(u,) for u in universe], "s1_id string"), pairs(truth), pairs(predicted))).first()


def test_metrics(spark):
    m = macro(spark, [("a", "S2-00047"), ("a", "S3-00812")], [("a", "S2-00047"), ("a", "S2-00193"), ("a", "S3-00812")], ["a"])
    assert round(m.macro_f05, 3) == 0.714 and m.macro_recall == 1 and m.singleton_accuracy == 1
    assert macro(spark, [], [], ["a"]).macro_f05 == 1
    m = macro(spark, [], [("a", "x")], ["a"])
    assert (m.macro_f05, m.macro_precision, m.macro_recall, m.singleton_accuracy) == (0, 0, 1, 0)
    assert macro(spark, [("a", "x")], [], ["a"]).macro_f05 == 0
    assert macro(spark, [("a", "x")], [("b", "x")], []).macro_f05 == 0


def test_auc_and_precision(spark):
    rows = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.8, 0)]
    df = spark.createDataFrame(rows, "prob double, label int")
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert metrics.roc_auc(df).first().roc_auc == pytest.approx(want)
    assert metrics.average_precision(df).first().average_precision == pytest.approx((1 / 2 + 2 / 4) / 2)
    assert metrics.roc_auc(df.filter("label = 1")).first().roc_auc is None


def test_grid(spark):
    assert len(tuning.GRID) == 39
    assert [sum(s == x for s, _ in tuning.GRID) for x in tuning.LEVELS] == [4, 5, 6, 7, 7, 5, 5]
    grid = tuning.threshold_grid(spark.createDataFrame([("S1-1",), ("S1-2",)], "s1_id string"), spark.createDataFrame([("S1-1", "S2-0")], "s1_id string, t_id string"), scored(spark, [0.9, 0.6]))
    got = {(r.sing, r.tau): r.macro_f05 for r in grid.collect()}
    assert len(got) == 39 and got[0.55, 0.65] == 1 and got[0.55, 0.55] < 1
    best = tuning.best_cell(grid).first()
    assert (best.sing, best.tau) == (0.55, 0.65)


def test_exact_quota(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 7 > 0).alias("s"))
    got = training.stratified_holdout(df, "s", "id", 101).groupBy("s").count().collect()
    assert sum(r["count"] for r in got) == 101
    pairs = df.select(F.col("id").alias("s1_id"), F.col("id").alias("t_id"), F.col("s").cast("int").alias("label"))
    folds = {(r.label, r.fold): r["count"] for r in training.split_pairs(pairs).groupBy("label", "fold").count().collect()}
    assert folds[1, "valid"] == -(-857 * 15 // 100) and sum(folds.values()) == 1000


def test_scorers(spark, tmp_path):
    names = X.FEATURE_NAMES
    rows = [tuple(float((i * 7 + j) % 5) for j in range(len(names))) + (i % 2,) for i in range(200)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", label int")
    assert Scorecard().score(df).filter("prob < 0 or prob > 1").count() == 0
    with pytest.raises(RuntimeError):
        BoostedTrees().score(df)
    model = BoostedTrees(thresholds=decide.Thresholds(0.6, 0.62)).fit(df, rounds=20, depth=3)
    assert model.score(df).filter("prob < 0 or prob > 1").count() == 0 and len(model.importances()) == 10
    path = str(tmp_path / "model")
    model.save(spark, path)
    again = BoostedTrees.load(spark, str(tmp_path / "none"), path)  # the first that exists
    assert again.thresholds == decide.Thresholds(0.6, 0.62) and again.importances() == model.importances()
    assert [r.prob for r in again.score(df).collect()] == [r.prob for r in model.score(df).collect()]
    with pytest.raises(FileNotFoundError):
        BoostedTrees.load(spark, str(tmp_path / "none"))


def test_unicode_digits(spark):
    assert keys_of(spark, "tesla", "१२ nehru road ११०००१", "११०००१") >= {"addr:१२_nehru", "post:११०००१_१२"}
    f = features(spark, ("a", "a", "१२ oak", "११०००१"), ("a", "a", "१२ elm", "११०००१"))
    assert f.number_match == 1 and f.postal_exact_match == 1


def test_fuzzy_features_by_pairs(spark):
    """The features made of LCS lengths, against plain Python over every kind of pair."""
    from .test_similarity import partial_ratio, ratio, token_set_ratio, token_sort_ratio

    texts = ["", "acme", "acme corp", "corp acme", "acme delta corp", "zeta", "the acme company of delta", "a" * 70 + " acme", "Éa日本 x"]
    rows = [(f"S2-{i}-{j}", a, b) for i, a in enumerate(texts) for j, b in enumerate(texts)]
    df = spark.createDataFrame([("S1-1", t, a, a, a, None, b, b, b, None) for t, a, b in rows], "s1_id string, t_id string, s_name_clean string, s_name_core string, s_addr_clean string, s_postal string, t_name_clean string, t_name_core string, t_addr_clean string, t_postal string")
    got = {r.t_id: r for r in X.pair_features(df).collect()}
    for t, a, b in rows:
        r, both = got[t], bool(a and b)
        assert r.name_fuzz_ratio == r.name_core_fuzz_ratio == pytest.approx(ratio(a, b))
        assert r.name_fuzz_partial_ratio == pytest.approx(partial_ratio(a, b))
        assert r.name_fuzz_token_sort == pytest.approx(token_sort_ratio(a, b)) and r.name_fuzz_token_set == pytest.approx(token_set_ratio(a, b))
        assert r.addr_fuzz_token_sort == pytest.approx(token_sort_ratio(a, b) if both else 0) and r.addr_fuzz_token_set == pytest.approx(token_set_ratio(a, b) if both else 0)
        assert r.name_addr_geom_mean == pytest.approx(token_set_ratio(a, b) * (1 if both else 0.5))


def test_quota_edges(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("id"), (F.col("id") % 2).alias("s"))
    quota = spark.createDataFrame([(0, 500), (1, 0)], "s long, n_take long")
    assert {r.s for r in training.take_by_hash(df, "s", F.col("id"), quota).collect()} == {0}
    assert training.take_by_hash(df, "s", F.col("id"), quota).count() == 50
    whole = [(r.s1_id, r.fold) for r in training.split_pairs(df.select(F.col("id").alias("s1_id"), F.col("id").alias("t_id"), F.lit(1).alias("label")), 1.0).collect()]
    assert {f for _, f in whole} == {"valid"}
    import hashlib

    pairs = [(f"S1-{i}", f"S2-{i}", i % 3 == 0) for i in range(200)]
    got = {(r.s1_id, r.fold) for r in training.split_pairs(spark.createDataFrame([(a, b, int(y)) for a, b, y in pairs], "s1_id string, t_id string, label int")).collect()}
    want = set()
    for label in (True, False):
        own = sorted((hashlib.md5(f"42{a}|{b}".encode()).hexdigest(), a) for a, b, y in pairs if y == label)
        take = -(-len(own) * 15 // 100)
        want |= {(a, "valid" if k < take else "train") for k, (_, a) in enumerate(own)}
    assert got == want


def test_all_keys_count_without_a_cap(spark):
    """Against scores of every pair, whichever keys are taken as frequent."""
    words = ["alpha", "delta", "granite", "orchid", "summit", "harbour"]

    def made(src, size, steps):
        names = [" ".join(words[(i * step + k) % 6] for k, step in enumerate(steps)) for i in range(size)]
        rows = [("India" if i % 5 == 0 else "US", f"{src}-{i}", n, n, f"{i % 7} station road", None if i % 3 else "12345") for i, n in enumerate(names)]
        return blocking_keys(records(spark, rows)).cache()

    s, t = made("S1", 60, (1, 5, 7)), made("S2", 150, (1, 7, 11))
    pairs = s.alias("s").join(t.alias("t"), ["country", "key"]).groupBy(F.col("s.entity_id").alias("s1_id"), F.col("t.entity_id").alias("t_id")).agg(F.sum("s.weight").alias("score"))
    wanted = sorted(map(tuple, B.top_candidates(pairs, 7).collect()))
    assert len(wanted) == 60 * 7
    for frequent in (0, 20, 60):
        assert sorted(map(tuple, B.whole_candidates(s, t, 7, frequent).collect())) == wanted


def test_training_sees_pairs_of_frequent_keys(spark):
    record = "country string, entity_id string, business_name string, business_address string"
    s = spark.createDataFrame([("US", "S1-1", "acme", None)], record)
    t = spark.createDataFrame([("US", f"S2-{i:03}", "acme", None) for i in range(B.MAX_POSTINGS + 1)], record)
    truth = spark.createDataFrame([("S1-1", "S2-300")], "s1_id string, t_id string")
    model, valid = R.train(s, t, truth, rounds=1)
    assert valid.count() == 4  # 15 % of 15 candidates and of a true pair, rounded up
