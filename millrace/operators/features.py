"""Features of a pair of normalised records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.similarity import common_lengths, fuzz_partial_ratio, ratio, sorted_tokens, token_set_ratio, token_sets
from millrace.functions.text import DIGIT, tokens

# The features, in the order of a feature vector.
FEATURE_NAMES = [
    "name_exact_clean",
    "name_exact_core",
    "name_compact_match",
    "name_fuzz_ratio",
    "name_fuzz_partial_ratio",
    "name_fuzz_token_sort",
    "name_fuzz_token_set",
    "name_core_fuzz_ratio",
    "name_len_diff",
    "name_len_ratio",
    "name_token_jaccard",
    "name_char3gram_jaccard",
    "is_s23_addr_missing",
    "is_both_addr_present",
    "addr_fuzz_token_sort",
    "addr_fuzz_token_set",
    "addr_token_jaccard",
    "postal_exact_match",
    "postal_mismatch",
    "number_match",
    "name_addr_geom_mean",
    "source_is_s2",
    "source_is_s3",
]
#: Those that need an edit similarity.
FUZZY = {n for n in FEATURE_NAMES if "fuzz" in n} | {"name_addr_geom_mean"}

_META = ["name_clean", "name_core", "addr_clean", "postal"]


def pairs_with_meta(pairs: DataFrame, references: DataFrame, targets: DataFrame) -> DataFrame:
    """``pairs`` with both sides' normal forms as ``s_*`` and ``t_*``; pairs of unknown ids drop out."""
    s = references.select(F.col("entity_id").alias("s1_id"), *(F.col(c).alias(f"s_{c}") for c in _META))
    t = targets.select(F.col("entity_id").alias("t_id"), *(F.col(c).alias(f"t_{c}") for c in _META))
    return pairs.join(t, "t_id").join(s, "s1_id")


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def char_ngrams(s: Column, n: int = 3) -> Column:
    """Distinct n-grams; a shorter text is its own only one, the empty text has none."""
    whole = F.when(s == "", F.array().cast("array<string>")).otherwise(F.array(s))
    return F.when(F.length(s) < n, whole).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - (n - 1), F.lit(1))), lambda i: F.substring(s, i, F.lit(n)))))


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("double")


def plain_features(pairs: DataFrame) -> DataFrame:
    """The features that built-in functions express."""
    c = F.col
    both = (c("s_addr_clean") != "") & (c("t_addr_clean") != "")
    posted = both & c("s_postal").isNotNull() & c("t_postal").isNotNull()
    compact = [F.replace(c(f"{x}_name_core"), F.lit(" "), F.lit("")) for x in "st"]
    size = [F.length(f"{x}_name_clean") for x in "st"]
    numbers = [F.filter(tokens(c(f"{x}_addr_clean")), lambda t: t.rlike(f"^{DIGIT}+$")) for x in "st"]
    return pairs.withColumns(
        {
            "name_exact_clean": _flag((c("s_name_clean") == c("t_name_clean")) & (c("s_name_clean") != "")),
            "name_exact_core": _flag((c("s_name_core") == c("t_name_core")) & (c("s_name_core") != "")),
            "name_compact_match": _flag((compact[0] == compact[1]) & (compact[0] != "")),
            "name_len_diff": F.abs(size[0] - size[1]).cast("double"),
            "name_len_ratio": F.when(F.greatest(*size) > 0, F.least(*size) / F.greatest(*size)).otherwise(0.0),
            "name_token_jaccard": jaccard(F.array_distinct(tokens(c("s_name_core"))), F.array_distinct(tokens(c("t_name_core")))),
            "name_char3gram_jaccard": jaccard(char_ngrams(c("s_name_core")), char_ngrams(c("t_name_core"))),
            "is_s23_addr_missing": _flag(c("t_addr_clean") == ""),
            "is_both_addr_present": _flag(both),
            "addr_token_jaccard": F.when(both, jaccard(F.array_distinct(tokens(c("s_addr_clean"))), F.array_distinct(tokens(c("t_addr_clean"))))).otherwise(0.0),
            "postal_exact_match": _flag(posted & (c("s_postal") == c("t_postal"))),
            "postal_mismatch": _flag(posted & (c("s_postal") != c("t_postal"))),
            "number_match": _flag(both & F.arrays_overlap(*numbers)),
            "source_is_s2": _flag(c("t_id").startswith("S2-")),
            "source_is_s3": _flag(c("t_id").startswith("S3-")),
        }
    )


def fuzzy_features(pairs: DataFrame) -> DataFrame:
    """The edit similarities: tokens are compared by built-in functions, all LCS lengths come from one Arrow stage."""
    c, sides = F.col, ("name_clean", "addr_clean")
    both = (c("s_addr_clean") != "") & (c("t_addr_clean") != "")
    made = {}
    for side in sides:
        s, t = c(f"s_{side}"), c(f"t_{side}")
        made |= {f"__{side}_sorted_s": sorted_tokens(s), f"__{side}_sorted_t": sorted_tokens(t)}
        made |= dict(zip((f"__{side}_base", f"__{side}_only_s", f"__{side}_only_t"), token_sets(s, t), strict=True))
    wanted = [("s_name_clean", "t_name_clean"), ("s_name_core", "t_name_core")]
    wanted += [(f"__{side}_{kind}_s", f"__{side}_{kind}_t") for side in sides for kind in ("sorted", "only")]
    out = pairs.withColumns(made)
    out = out.withColumns({"__common": common_lengths([(c(a), c(b)) for a, b in wanted]), "name_fuzz_partial_ratio": fuzz_partial_ratio(c("s_name_clean"), c("t_name_clean"))})
    common = {pair: F.element_at("__common", k + 1) for k, pair in enumerate(wanted)}
    plain = lambda a, b: ratio(c(a), c(b), common[a, b])
    by_sets = {}
    for side in sides:
        only = (f"__{side}_only_s", f"__{side}_only_t")
        by_sets[side] = token_set_ratio(c(f"s_{side}"), c(f"t_{side}"), c(f"__{side}_base"), *map(c, only), common[only])
    out = out.withColumns(
        {
            "name_fuzz_ratio": plain("s_name_clean", "t_name_clean"),
            "name_fuzz_token_sort": plain("__name_clean_sorted_s", "__name_clean_sorted_t"),
            "name_fuzz_token_set": by_sets["name_clean"],
            "name_core_fuzz_ratio": plain("s_name_core", "t_name_core"),
            "addr_fuzz_token_sort": F.when(both, plain("__addr_clean_sorted_s", "__addr_clean_sorted_t")).otherwise(0.0),
            "addr_fuzz_token_set": F.when(both, by_sets["addr_clean"]).otherwise(0.0),
        }
    )
    geometric = F.when(both, F.sqrt(c("name_fuzz_token_set") * c("addr_fuzz_token_set"))).otherwise(c("name_fuzz_token_set") * 0.5)
    return out.withColumn("name_addr_geom_mean", geometric).drop("__common", *made)


def pair_features(pairs: DataFrame) -> DataFrame:
    """``s1_id, t_id`` and all features, in their order."""
    return fuzzy_features(plain_features(pairs)).select("s1_id", "t_id", *FEATURE_NAMES)
