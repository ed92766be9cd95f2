"""Blocking keys: what two records may share to be compared at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import NUMBER, tokens

# Words that say too little about a name to be a key.
STOPWORDS = [
    "and", "the", "for", "with", "from", "center", "centre", "group", "services",
    "consulting", "solutions", "international", "national", "global", "holdings",
    "enterprises", "associates", "management", "products", "systems", "trading",
    "tech", "india", "american", "us", "de", "la", "le", "des", "du", "et", "en",
    "of", "co", "corp", "inc", "ltd", "llc", "sarl", "sas", "pvt", "limited",
]

# Weight of a shared key by its kind; kinds not named weigh 1.
WEIGHTS = {"nc": 6.0, "cmp": 5.0, "pfx2": 4.0, "post": 3.0, "addr": 3.0, "tok": 2.0}
OTHER_WEIGHT = 1.0

KINDS = ("nc", "cmp", "tok", "p4", "pfx2", "pfx1", "addr", "post", "post_str")


def _none() -> Column:
    return F.array().cast("array<string>")


def _telling(words: Column) -> Column:
    stop = F.array(*(F.lit(w) for w in STOPWORDS))
    return F.filter(words, lambda t: ~F.array_contains(stop, t))


def _one(kind: str, when: Column, value: Column) -> Column:
    return F.when(when, F.array(F.concat(F.lit(f"{kind}:"), value))).otherwise(_none())


def key_arrays(normal: DataFrame) -> DataFrame:
    """``normal`` with an array column ``k_<kind>`` for every kind of key (empty where it has none).

    Helper columns are computed in a projection of their own.
    """
    words = normal.withColumns(
        {
            "__name": _telling(tokens(F.col("name_core"))),
            "__compact": F.replace(F.col("name_core"), F.lit(" "), F.lit("")),
            "__streets": F.filter(_telling(tokens(F.col("addr_clean"))), lambda t: (F.length(t) >= 4) & t.rlike(r"^\p{L}+$")),
            "__number": F.try_element_at(F.regexp_extract_all("addr_clean", F.lit(NUMBER), 1), F.lit(1)),
        }
    )
    name, number, streets = F.col("__name"), F.col("__number"), F.col("__streets")
    long = F.filter(name, lambda t: F.length(t) >= 4)
    first = F.try_element_at(name, F.lit(1))
    keyed = words.withColumns(
        {
            "k_nc": _one("nc", F.length("name_core") >= 4, F.col("name_core")),
            "k_cmp": _one("cmp", F.length("__compact") >= 5, F.substring("__compact", 1, 25)),
            "k_tok": F.transform(long, lambda t: F.concat(F.lit("tok:"), t)),
            "k_p4": F.transform(F.filter(long, lambda t: F.length(t) >= 6), lambda t: F.concat(F.lit("p4:"), F.substring(t, 1, 4))),
            "k_pfx2": _one("pfx2", F.size(name) >= 2, F.concat_ws("_", first, F.try_element_at(name, F.lit(2)))),
            "k_pfx1": _one("pfx1", (F.size(name) == 1) & (F.length(first) >= 4), F.substring(first, 1, 5)),
            "k_addr": F.when(number.isNotNull(), F.transform(F.slice(streets, 1, 2), lambda w: F.concat(F.lit("addr:"), number, F.lit("_"), w))).otherwise(_none()),
            "k_post": _one("post", F.col("postal").isNotNull() & number.isNotNull(), F.concat_ws("_", "postal", number)),
            "k_post_str": _one("post_str", F.col("postal").isNotNull() & number.isNull() & (F.size(streets) > 0), F.concat_ws("_", "postal", F.try_element_at(streets, F.lit(1)))),
        }
    )
    return keyed.drop("__name", "__compact", "__streets", "__number")


def kind_of(key: Column) -> Column:
    return F.substring_index(key, ":", 1)


def weight_of(key: Column) -> Column:
    pairs = F.create_map(*(F.lit(x) for kv in WEIGHTS.items() for x in kv))
    return F.coalesce(F.try_element_at(pairs, kind_of(key)), F.lit(OTHER_WEIGHT))


def blocking_keys(normal: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """One row per record and distinct key: ``country, entity_id, key, weight``."""
    arrays = key_arrays(normal)
    every = F.array_distinct(F.concat(*(F.col(f"k_{k}") for k in kinds)))
    rows = arrays.select("country", "entity_id", F.explode(every).alias("key"))
    return rows.withColumn("weight", weight_of(F.col("key")))
