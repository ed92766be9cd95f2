"""All registered queries of the record-linkage operators and their DuckDB equivalents.

A query takes ``(spark, sf_dir)``. The SQL of each is built from the same
chain of named steps (``normal``, ``keys``, ``cands``, ``feats``, ``scored``),
written for DuckDB independently of the DataFrame code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import blocking as B
from millrace.operators import decide, metrics, training, tuning, validate
from millrace.operators import features as X
from millrace.operators.keys import KINDS, STOPWORDS, WEIGHTS, blocking_keys, key_arrays
from millrace.operators.model import BoostedTrees, Scorecard
from millrace.plans import resolve as R
from millrace.sources import fixtures, tsv
from millrace.sources.scratch import scratch_dir, write_bytes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: The cap never binds on small tables; this one does.
LOW_CAP = 30


def register(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# Inputs


def _src(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.sources(spark, sf_dir)


def _normal(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Normalised references and targets (kept: key sizes and both sides of the joins read them)."""
    normal = T.normalize(_src(spark, sf_dir))
    return R.kept(normal.filter("src = 'S1'")), R.kept(normal.filter("src <> 'S1'"))


def _candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    s, t = _normal(spark, sf_dir)
    return B.generate_candidates(s, t), s, t


def _scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Probabilities rounded, so that both engines compare the same numbers with thresholds."""
    c, s, t = _candidates(spark, sf_dir)
    return R.score_pairs(c, s, t).select("s1_id", "t_id", "rn", F.round("prob", 9).alias("prob")), s, t


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.truth(_src(spark, sf_dir))


# The chain of steps in SQL


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _low(c: str) -> str:
    return f"translate(lower(trim(case when {c} is null or lower({c}) = 'nan' then '' else {c} end, {_SPACES})), '{T.LATIN_FROM}', '{T.LATIN_TO}')"


def _symbols(x: str) -> str:
    return f"replace(replace(replace({x}, '&', ' and '), '@', ' at '), '+', ' ')"


def _spaced(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def _punct(x: str) -> str:
    return f"regexp_replace({x}, '{T.NOT_WORD}', ' ', 'g')"


def _tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda x: x <> '')"


def _unsuffixed(x: str) -> str:
    once = f"trim(regexp_replace({x}, '{T.SUFFIX_AT_END}', ''))"
    return f"case when length({once}) >= 2 then {once} else {x} end"


_NAME = _spaced(_punct(_symbols(f"regexp_replace(regexp_replace(lname, '{T.URL_PREFIX}', ''), '{T.DOMAIN_SUFFIX}', '')")))
_ABBR = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in T.ADDRESS_ABBREVIATIONS.items()) + "}"
_ADDR_WORDS = _tokens(_punct("replace(replace(laddr, '&', ' and '), '-', ' ')"))
# Written for an engine without look-around: what stands before the last run of digits is taken greedily.
_POSTAL = r"nullif(regexp_extract(laddr, '^(?:.*[^\p{L}\p{N}_])?(\p{Nd}{5,6})(?:[^\p{L}\p{N}_].*)?$', 1, 's'), '')"
_NUMBER = r"nullif(regexp_extract(addr_clean, '(?:^|[^\p{L}\p{N}_])(\p{Nd}+)(?:[^\p{L}\p{N}_]|$)', 1), '')"

_SRC = fixtures.SOURCES_SQL.format(customer="customer", part="part")
_NORMAL = (
    _SRC
    + f""", low as (select src, k, entity_id, country, business_name, business_address, {_low("business_name")} lname, {_low("business_address")} laddr from src),
n1 as (select *, {_NAME} name_clean, array_to_string(list_transform({_ADDR_WORDS}, lambda w: coalesce({_ABBR}[w], w)), ' ') addr_clean, {_POSTAL} postal from low),
n2 as (select *, {_unsuffixed("name_clean")} once from n1),
normal as (select *, {_spaced(_unsuffixed("once"))} name_core from n2)"""
)
_STOP = _list(STOPWORDS)
_KEYS = (
    _NORMAL
    + f""", w as (select *, list_filter({_tokens("name_core")}, lambda x: not list_contains({_STOP}, x)) names, replace(name_core, ' ', '') compact,
  list_filter({_tokens("addr_clean")}, lambda x: length(x) >= 4 and regexp_full_match(x, '\\p{{L}}+') and not list_contains({_STOP}, x)) streets,
  {_NUMBER} num from normal),
k0 as (
  select src, country, entity_id, 'nc' kind, 'nc:' || name_core as key from w where length(name_core) >= 4
  union select src, country, entity_id, 'cmp', 'cmp:' || substr(compact, 1, 25) from w where length(compact) >= 5
  union select src, country, entity_id, 'tok', 'tok:' || x from (select *, unnest(list_filter(names, lambda x: length(x) >= 4)) x from w)
  union select src, country, entity_id, 'p4', 'p4:' || substr(x, 1, 4) from (select *, unnest(list_filter(names, lambda x: length(x) >= 6)) x from w)
  union select src, country, entity_id, 'pfx2', 'pfx2:' || names[1] || '_' || names[2] from w where len(names) >= 2
  union select src, country, entity_id, 'pfx1', 'pfx1:' || substr(names[1], 1, 5) from w where len(names) = 1 and length(names[1]) >= 4
  union select src, country, entity_id, 'addr', 'addr:' || num || '_' || x from (select *, unnest(streets[1:2]) x from w) where num is not null
  union select src, country, entity_id, 'post', 'post:' || postal || '_' || num from w where postal is not null and num is not null
  union select src, country, entity_id, 'post_str', 'post_str:' || postal || '_' || streets[1] from w where postal is not null and num is null and len(streets) > 0
), keys as (select *, case kind {" ".join(f"when '{k}' then {v}::double" for k, v in WEIGHTS.items())} else 1::double end weight from k0)"""
)


def _cands(cap: int = B.MAX_POSTINGS) -> str:
    return (
        _KEYS
        + f""", size as (select country, key, count(*) n from keys where src <> 'S1' group by all),
post as (select keys.* from keys join size using (country, key) where src <> 'S1' and n <= {cap}),
tally as (select s.entity_id s1_id, t.entity_id t_id, sum(s.weight) score from keys s join post t on s.country = t.country and s.key = t.key where s.src = 'S1' group by all),
cands as (select *, (row_number() over (partition by s1_id order by score desc, t_id))::int rn from tally qualify rn <= {B.MAX_CANDIDATES})"""
    )


_TRUTH = "truth as (select s.entity_id s1_id, t.entity_id t_id from src s join src t on s.k = t.k where s.src = 'S1' and t.src <> 'S1')"
_CANDS = _cands()


def _jac(a: str, b: str) -> str:
    return f"case when len({a}) = 0 or len({b}) = 0 then 0.0::double else len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))) end"


def _grams(x: str) -> str:
    return f"case when {x} = '' then []::varchar[] when length({x}) < 3 then [{x}] else list_distinct(list_transform(range(1, length({x}) - 1), lambda i: substr({x}, i, 3))) end"


_BOTH = "(sa <> '' and ta <> '')"
_FEATS = (
    _CANDS
    + f""", meta as (select c.s1_id, c.t_id, c.rn, s.name_clean sn, t.name_clean tn, s.name_core sc, t.name_core tc, s.addr_clean sa, t.addr_clean ta, s.postal sp, t.postal tp,
  {_tokens("s.name_core")} sct, {_tokens("t.name_core")} tct, {_tokens("s.addr_clean")} sat, {_tokens("t.addr_clean")} tat, {_grams("s.name_core")} sg, {_grams("t.name_core")} tg
  from cands c join normal s on s.entity_id = c.s1_id join normal t on t.entity_id = c.t_id),
feats as (select s1_id, t_id, rn,
  (sn = tn and sn <> '')::int::double name_exact_clean, (sc = tc and sc <> '')::int::double name_exact_core,
  (replace(sc, ' ', '') = replace(tc, ' ', '') and replace(sc, ' ', '') <> '')::int::double name_compact_match,
  abs(length(sn) - length(tn))::double name_len_diff,
  case when greatest(length(sn), length(tn)) > 0 then least(length(sn), length(tn)) / greatest(length(sn), length(tn)) else 0.0 end::double name_len_ratio,
  {_jac("sct", "tct")} name_token_jaccard, {_jac("sg", "tg")} name_char3gram_jaccard,
  (ta = '')::int::double is_s23_addr_missing, {_BOTH}::int::double is_both_addr_present,
  case when {_BOTH} then {_jac("sat", "tat")} else 0.0::double end addr_token_jaccard,
  coalesce({_BOTH} and sp = tp, false)::int::double postal_exact_match, coalesce({_BOTH} and sp <> tp, false)::int::double postal_mismatch,
  ({_BOTH} and list_has_any(list_filter(sat, lambda x: regexp_full_match(x, '\\p{{Nd}}+')), list_filter(tat, lambda x: regexp_full_match(x, '\\p{{Nd}}+'))))::int::double number_match,
  starts_with(t_id, 'S2-')::int::double source_is_s2, starts_with(t_id, 'S3-')::int::double source_is_s3 from meta)"""
)
_Z = " + ".join([f"({Scorecard.BIAS})", *(f"({w}) * {n}" for n, w in Scorecard.WEIGHTS.items())])
_SCORED = _FEATS + f", scored as (select s1_id, t_id, rn, round(1 / (1 + exp(-({_Z}))), 9) prob from feats), {_TRUTH}"


def _shielded(tau: float, sing: float) -> str:
    return f"select s1_id, t_id, rn, prob from (select *, max(prob) over (partition by s1_id) top from scored) where top >= {sing} and prob >= {tau}"


_MATCHED = _SCORED + f", found as ({_shielded(decide.PIPELINE.tau, decide.PIPELINE.sing)})"


def _counts(pairs: str) -> str:
    return f"""cnt as (select s.entity_id s1_id,
  (select count(*) from truth t where t.s1_id = s.entity_id) n_true, (select count(*) from {pairs} p where p.s1_id = s.entity_id) n_pred,
  (select count(*) from truth t join {pairs} p on p.s1_id = t.s1_id and p.t_id = t.t_id where t.s1_id = s.entity_id) tp from src s where s.src = 'S1')"""


_F05 = "case when n_true = 0 then case when n_pred = 0 then 1.0 else 0.0 end when n_pred = 0 or tp = 0 then 0.0 else 1.25 * (tp / n_pred) * (tp / n_true) / (0.25 * (tp / n_pred) + tp / n_true) end::double"
_PREC = "case when n_true = 0 then case when n_pred = 0 then 1.0 else 0.0 end when n_pred = 0 then 0.0 else tp / n_pred end::double"
_REC = "case when n_true = 0 then 1.0 else tp / n_true end::double"
_SING = "coalesce(avg(case when n_true = 0 then (n_pred = 0)::int::double end), 1.0)"

# Text


@register(f"select page_id, regexp_replace(url, '{T.URL_PREFIX}', '') stripped from pages")
def url_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", T.url_strip(F.col("url")).alias("stripped"))


@register(f"select page_id, regexp_replace(url, '{T.DOMAIN_SUFFIX}', '') stripped from pages")
def domain_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", T.domain_strip(F.col("url")).alias("stripped"))


@register(_SRC + f" select entity_id, {_symbols('business_name')} mapped from src")
def symbol_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _src(spark, sf_dir).select("entity_id", T.symbol_map(F.col("business_name")).alias("mapped"))


@register(f"select doc_id, md5({_spaced(_punct('text'))}) digest from documents")
def punct_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.md5(T.punct_collapse(F.col("text")).cast("binary")).alias("digest"))


@register("select doc_id, md5(strip_accents(text)) digest from documents")
def strip_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return T.fold_accents(docs, ["text"]).select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@register(_NORMAL + " select entity_id, once, name_core from normal")
def legal_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = T.normalize(_src(spark, sf_dir))
    once = T.let(F.trim(F.regexp_replace("name_clean", T.SUFFIX_AT_END, "")), lambda t: F.when(F.length(t) >= 2, t).otherwise(F.col("name_clean")))
    return n.select("entity_id", once.alias("once"), "name_core")


@register(_NORMAL + " select entity_id, name_clean, name_core from normal")
def normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.normalize(_src(spark, sf_dir)).select("entity_id", "name_clean", "name_core")


@register(_NORMAL + " select entity_id, postal from normal")
def postal_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _src(spark, sf_dir).select("entity_id", T.postal_extract(T.strip_latin_accents(T.lowered(F.col("business_address")))).alias("postal"))


@register(_SRC + f" select entity_id, array_to_string(list_transform({_tokens('lower(business_address)')}, lambda w: coalesce({_ABBR}[w], w)), ' ') expanded from src where business_address is not null")
def abbr_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _src(spark, sf_dir).filter("business_address is not null")
    return rows.select("entity_id", F.array_join(T.abbr_expand(T.tokens(F.lower("business_address"))), " ").alias("expanded"))


@register(_NORMAL + " select entity_id, addr_clean, postal from normal")
def normalize_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.normalize(_src(spark, sf_dir)).select("entity_id", "addr_clean", "postal")


# Keys and blocking


def _key_query(kind: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        arrays = key_arrays(T.normalize(_src(spark, sf_dir)))
        return arrays.select("entity_id", F.explode(F.array_distinct(f"k_{kind}")).alias("key"))

    query.__name__ = f"key_{kind}"
    register(_KEYS + f" select entity_id, key from keys where kind = '{kind}'")(query)


for _kind in KINDS:
    _key_query(_kind)


@register(_KEYS + " select entity_id, country, key, weight from keys")
def blocking_keys_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking_keys(T.normalize(_src(spark, sf_dir))).select("entity_id", "country", "key", "weight")


QUERIES["blocking_keys"], SQL["blocking_keys"] = QUERIES.pop("blocking_keys_all"), SQL.pop("blocking_keys_all")


@register(_SRC + " select s.country, s.n_s1, t.n_targets from (select country, count(*) n_s1 from src where src = 'S1' group by 1) s left join (select country, count(*) n_targets from src where src <> 'S1' group by 1) t on s.country = t.country")
def country_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _src(spark, sf_dir)
    n = src.groupBy("country").agg(F.count_if(F.col("src") == "S1").alias("n_s1"), F.count_if(F.col("src") != "S1").alias("n_targets"))
    return n.filter("n_s1 > 0")


@register(_SRC + " select entity_id, business_name, business_address, country from src where src = 'S2' union all select entity_id, business_name, business_address, country from src where src = 'S3'")
def union_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _src(spark, sf_dir)
    return B.union_targets(src.filter("src = 'S2'"), src.filter("src = 'S3'")).select("entity_id", "business_name", "business_address", "country")


@register(_KEYS + " select country, key, count(*) n, min(entity_id) first_id, max(entity_id) last_id from keys where src <> 'S1' group by all")
def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, t = _normal(spark, sf_dir)
    return blocking_keys(t).groupBy("country", "key").agg(F.count(F.lit(1)).alias("n"), F.min("entity_id").alias("first_id"), F.max("entity_id").alias("last_id"))


@register(_KEYS + f", size as (select country, key, count(*) n from keys where src <> 'S1' group by all) select country, key, n, n > {LOW_CAP} over_low, n > {B.MAX_POSTINGS} over_cap from size")
def hot_key_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, t = _normal(spark, sf_dir)
    return B.key_sizes(blocking_keys(t)).select("country", "key", "n", (F.col("n") > LOW_CAP).alias("over_low"), (F.col("n") > B.MAX_POSTINGS).alias("over_cap"))


@register(_cands(LOW_CAP) + " select s1_id, t_id, score, rn from cands")
def candidates_low_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = _normal(spark, sf_dir)
    return B.generate_candidates(s, t, LOW_CAP)


@register(_CANDS + " select s1_id, t_id, score from tally")
def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = _normal(spark, sf_dir)
    return B.candidate_scores(blocking_keys(s), blocking_keys(t))


@register(_CANDS + " select s1_id, t_id, rn from cands")
def candidates_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir)[0].select("s1_id", "t_id", "rn")


@register(_CANDS + " select s.entity_id s1_id, coalesce(string_agg(t_id, ',' order by rn), '') candidates, count(t_id) n from src s left join cands c on c.s1_id = s.entity_id where s.src = 'S1' group by 1")
def candidates_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s, _ = _candidates(spark, sf_dir)
    return B.candidate_lists(s, c).select("s1_id", F.array_join("candidates", ",").alias("candidates"), F.size("candidates").cast("long").alias("n"))


@register(_CANDS + " select s1_id, t_id, score, rn from cands")
def flagship_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir)[0]


# Features


def _feature_query(name: str, columns: list[str]) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        c, s, t = _candidates(spark, sf_dir)
        made = X.plain_features(X.pairs_with_meta(c, s, t))
        return made.select("s1_id", "t_id", *(F.round(f, 9).alias(f) for f in columns))

    query.__name__ = name
    register(_FEATS + " select s1_id, t_id, " + ", ".join(f"round({f}, 9) {f}" for f in columns) + " from feats")(query)


for _name, _columns in {
    "feat_exact": ["name_exact_clean", "name_exact_core", "name_compact_match"],
    "feat_len": ["name_len_diff", "name_len_ratio"],
    "feat_jaccard": ["name_token_jaccard", "addr_token_jaccard"],
    "feat_char3gram": ["name_char3gram_jaccard"],
    "feat_addr_flags": ["is_s23_addr_missing", "is_both_addr_present"],
    "feat_postal": ["postal_exact_match", "postal_mismatch"],
    "feat_number": ["number_match"],
    "feat_source": ["source_is_s2", "source_is_s3"],
}.items():
    _feature_query(_name, _columns)


@register()
def feat_fuzz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features of the candidates, edit similarities included; SQL has no equal of those."""
    c, s, t = _candidates(spark, sf_dir)
    return X.pair_features(X.pairs_with_meta(c, s, t))


# Scores, decisions, training


@register(_SCORED + " select s1_id, t_id, round(prob, 6) prob from scored")
def score_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir)[0].select("s1_id", "t_id", F.round("prob", 6).alias("prob"))


@register(_MATCHED + " select s1_id, t_id from found")
def singleton_shield(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.matches(_scored(spark, sf_dir)[0], decide.PIPELINE).select("s1_id", "t_id")


@register(_SCORED + f", found as ({_shielded(decide.RESCORE.tau, decide.RESCORE.sing)}) select s.entity_id s1_id, coalesce(string_agg(t_id, ',' order by rn), '') matched from src s left join found f on f.s1_id = s.entity_id where s.src = 'S1' group by 1")
def rescore(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s, t = _candidates(spark, sf_dir)
    saved = tsv.sink_rows(s, B.candidate_lists(s, c), "candidates", "candidate_entity_ids")
    return R.rescore_normal(saved, s, t).select("s1_id", F.array_join("matched", ",").alias("matched"))


_CELLS = ", ".join(f"({s}::double, {t}::double)" for s, t in tuning.GRID)
_GRID = _SCORED + f""", grid(sing, tau) as (values {_CELLS}),
top as (select *, max(prob) over (partition by s1_id) top from scored),
hits as (select sing, tau, s.s1_id, count(*) n_pred, count(t.t_id) tp from grid cross join top s left join truth t on t.s1_id = s.s1_id and t.t_id = s.t_id where top >= sing and prob >= tau group by 1, 2, 3),
nt as (select s1_id, count(*) n_true from truth group by 1),
cell as (select g.sing, g.tau, coalesce(n_true, 0) n_true, coalesce(n_pred, 0) n_pred, coalesce(tp, 0) tp from grid g cross join (select entity_id s1_id from src where src = 'S1') u
  left join nt on nt.s1_id = u.s1_id left join hits h on h.s1_id = u.s1_id and h.sing = g.sing and h.tau = g.tau),
res as (select sing, tau, avg({_F05}) macro_f05, avg({_PREC}) macro_precision, avg({_REC}) macro_recall, {_SING} singleton_accuracy from cell group by 1, 2)"""
_GRID_COLUMNS = ["macro_f05", "macro_precision", "macro_recall", "singleton_accuracy"]
_GRID_OUT = "sing, tau, " + ", ".join(f"round({c}, 6) {c}" for c in _GRID_COLUMNS)


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, s, _ = _scored(spark, sf_dir)
    return tuning.threshold_grid(s.select(F.col("entity_id").alias("s1_id")), _truth(spark, sf_dir), scored)


@register(_GRID + f" select {_GRID_OUT} from res")
def threshold_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir).select("sing", "tau", *(F.round(c, 6).alias(c) for c in _GRID_COLUMNS))


@register(_GRID + f" select {_GRID_OUT} from res order by round(macro_f05, 12) desc, sing, tau limit 1")
def best_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tuning.best_cell(_grid(spark, sf_dir)).select("sing", "tau", *(F.round(c, 6).alias(c) for c in _GRID_COLUMNS))


_PAIRS = _CANDS + f", {_TRUTH}, pairs as (select p.s1_id, p.t_id, (t.t_id is not null)::int as label from (select s1_id, t_id from cands union select s1_id, t_id from truth) p left join truth t on t.s1_id = p.s1_id and t.t_id = p.t_id)"


def _pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    c, s, t = _candidates(spark, sf_dir)
    return R.kept(training.training_pairs(c, _truth(spark, sf_dir), s, t)), s, t


@register(_PAIRS + " select s1_id, t_id, label from pairs")
def training_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)[0]


_SPLIT = _PAIRS + """, ranked as (select *, row_number() over (partition by label order by md5('42' || s1_id || '|' || t_id)) r, count(*) over (partition by label) n from pairs),
split as (select s1_id, t_id, label, case when r <= ceil(n * 0.15::double) then 'valid' else 'train' end fold from ranked)"""


@register(_SPLIT + " select s1_id, t_id, label, fold from split")
def split_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.split_pairs(_pairs(spark, sf_dir)[0]).select("s1_id", "t_id", "label", "fold")


@register(_PAIRS + " select round(avg(label), 9) positive_rate, count(*) n from pairs")
def positive_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)[0].agg(F.round(F.avg("label"), 9).alias("positive_rate"), F.count(F.lit(1)).alias("n"))


_HELD = 300
_HOLDOUT = _SRC + f""", truth as (select s.entity_id s1_id, t.entity_id t_id from src s join src t on s.k = t.k where s.src = 'S1' and t.src <> 'S1'),
rec as (select entity_id, country, country || '_' || case when exists (select 1 from truth where s1_id = entity_id) then 'False' else 'True' end strata from src where src = 'S1'),
q0 as (select strata, count(*) n, (count(*) * least({_HELD}, (select count(*) from rec)))::double / (select count(*) from rec) exact from rec group by 1),
q1 as (select *, floor(exact) base, least({_HELD}, (select count(*) from rec)) - sum(floor(exact)) over () rest, row_number() over (order by exact - floor(exact) desc, strata) place from q0),
r as (select rec.*, row_number() over (partition by rec.strata order by md5('42' || entity_id), entity_id) rn from rec)
select entity_id, country, r.strata from r join q1 on q1.strata = r.strata where rn <= base + (place <= rest)::int"""


@register(_HOLDOUT)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _src(spark, sf_dir)
    pairs = fixtures.truth(src).select(F.col("s1_id").alias("entity_id"), F.lit("False").alias("alone")).distinct()
    s = src.filter("src = 'S1'").select("entity_id", "country").join(pairs, "entity_id", "left")
    s = s.withColumn("strata", F.concat_ws("_", "country", F.coalesce("alone", F.lit("True")))).drop("alone")
    return training.stratified_holdout(s, "strata", "entity_id", min(_HELD, s.count()))


@register(_SCORED + """, l as (select prob, (t.t_id is not null)::int y from scored s left join truth t on t.s1_id = s.s1_id and t.t_id = s.t_id),
r as (select *, rank() over (order by prob) + (count(*) over (partition by prob) - 1) / 2 r from l)
select round((sum(case when y = 1 then r end) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)), 9) roc_auc from r""")
def roc_auc_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_auc(_labelled(spark, sf_dir)).select(F.round("roc_auc", 9).alias("roc_auc"))


@register(_SCORED + """, l as (select prob, (t.t_id is not null)::int y from scored s left join truth t on t.s1_id = s.s1_id and t.t_id = s.t_id),
g as (select prob, sum(y) pos, sum(1 - y) neg from l group by 1),
c as (select *, sum(pos) over (order by prob desc) tp, sum(neg) over (order by prob desc) fp from g)
select round(sum(pos * tp / (tp + fp)) / sum(pos), 9) average_precision from c""")
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.average_precision(_labelled(spark, sf_dir)).select(F.round("average_precision", 9).alias("average_precision"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _, _ = _scored(spark, sf_dir)
    hit = _truth(spark, sf_dir).withColumn("label", F.lit(1))
    return scored.join(hit, ["s1_id", "t_id"], "left").na.fill(0, ["label"])


@register()
def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees, fitted on the training fold, over the validation fold, which also ends the boosting."""
    model, valid = _gbt(spark, sf_dir)
    return valid.select("s1_id", "t_id", "label", "prob")


@register()
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = _gbt(spark, sf_dir)
    return spark.createDataFrame(model.importances(), "feature string, importance double")


def _gbt(spark: SparkSession, sf_dir: str) -> tuple[BoostedTrees, DataFrame]:
    src = _src(spark, sf_dir)
    return R.train(src.filter("src = 'S1'"), src.filter("src <> 'S1'"), _truth(spark, sf_dir))


# Metrics


def _matched_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, s, _ = _scored(spark, sf_dir)
    return metrics.entity_counts(s.select(F.col("entity_id").alias("s1_id")), _truth(spark, sf_dir), decide.matches(scored, decide.PIPELINE))


_MATCHED_COUNTS = _MATCHED + ", " + _counts("found")


@register(_MATCHED_COUNTS + f" select s1_id, n_true, n_pred, tp, round({_F05}, 9) f05 from cnt")
def entity_f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.entity_scores(_matched_counts(spark, sf_dir)).select("s1_id", "n_true", "n_pred", "tp", F.round("f05", 9).alias("f05"))


@register(_MATCHED_COUNTS + f" select round(avg({_F05}), 6) macro_f05, round(avg({_PREC}), 6) macro_precision, round(avg({_REC}), 6) macro_recall, count(*) n_entities, count(*) filter (where n_true = 0) n_singletons, round({_SING}, 6) singleton_accuracy from cnt")
def macro_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = metrics.macro_metrics(_matched_counts(spark, sf_dir))
    return m.select(*(F.round(c, 6).alias(c) if t == "double" else c for c, t in m.dtypes))


_BLOCKING = _CANDS + f", {_TRUTH}, q as (select (select count(*) from truth) n_true, (select count(*) from truth join cands using (s1_id, t_id)) hit, (select count(*) from cands) n_cand, (select count(*) from src where src = 'S1') n, (select count(*) from src where src <> 'S1') pool)"


def _blocking(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s, t = _candidates(spark, sf_dir)
    return metrics.blocking_quality(s.select(F.col("entity_id").alias("s1_id")), _truth(spark, sf_dir), c, t.count())


@register(_BLOCKING + " select round(hit / greatest(1, n_true), 9) recall from q")
def blocking_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blocking(spark, sf_dir).select(F.round("recall", 9).alias("recall"))


@register(_BLOCKING + " select round(n_cand / n, 9) avg_candidates from q")
def avg_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blocking(spark, sf_dir).select(F.round("avg_candidates", 9).alias("avg_candidates"))


_POOL = 150


@register(
    _KEYS
    + f""", truth as (select s.entity_id s1_id, t.entity_id t_id from src s join src t on s.k = t.k where s.src = 'S1' and t.src <> 'S1'),
pool as (select entity_id from (select entity_id, row_number() over (partition by src order by entity_id) r from src where src <> 'S1') where r <= {_POOL} or entity_id in (select t_id from truth)),
size as (select country, key, count(*) n from keys where entity_id in (select entity_id from pool) group by all),
post as (select keys.* from keys join size using (country, key) where entity_id in (select entity_id from pool) and n <= {B.MAX_POSTINGS}),
tally as (select s.entity_id s1_id, t.entity_id t_id, sum(s.weight) score from keys s join post t on s.country = t.country and s.key = t.key where s.src = 'S1' group by all),
cands as (select *, row_number() over (partition by s1_id order by score desc, t_id) rn from tally qualify rn <= {B.MAX_CANDIDATES}),
q as (select (select count(*) from truth) n_true, (select count(*) from truth join cands using (s1_id, t_id)) hit, (select count(*) from cands) n_cand, (select count(*) from src where src = 'S1') n, (select count(*) from pool) pool)
select round(hit / greatest(1, n_true), 9) recall, round(n_cand / n, 9) avg_candidates, round(1 - n_cand / n / pool, 9) reduction_ratio, pool from q"""
)
def blocking_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocking quality over a limited pool that the missing true targets are added to."""
    src = _src(spark, sf_dir)
    row = R.benchmark_blocking(src.filter("src = 'S1'"), src.filter("src <> 'S1'"), _truth(spark, sf_dir), _POOL)
    return row.select(*(F.round(c, 9).alias(c) for c in ("recall", "avg_candidates", "reduction_ratio")), "pool")


@register(_BLOCKING + " select round(1 - n_cand / n / pool, 9) reduction_ratio from q")
def reduction_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blocking(spark, sf_dir).select(F.round("reduction_ratio", 9).alias("reduction_ratio"))


@register(_SRC + " select country, count(*) n, round(count(*) / sum(count(*)) over (), 9) share from src where src = 'S1' group by 1")
def country_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.frequencies(_src(spark, sf_dir).filter("src = 'S1'"), "country").select("country", "n", F.round("share", 9).alias("share"))


@register(_MATCHED + " select country, count(*) n_entities, count(*) filter (where exists (select 1 from found f where f.s1_id = entity_id)) n_matched from src where src = 'S1' group by 1")
def match_rate_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, s, _ = _scored(spark, sf_dir)
    hit = decide.matches(scored, decide.PIPELINE).select(F.col("s1_id").alias("entity_id"), F.lit(1).alias("hit")).distinct()
    return s.join(hit, "entity_id", "left").groupBy("country").agg(F.count(F.lit(1)).alias("n_entities"), F.count("hit").alias("n_matched"))


# Sources and sinks


@register(_SRC + " select entity_id, business_name, business_address from src where src <> 'S1' and country = 'France'")
def scan_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tsv.records_of(_src(spark, sf_dir).filter("src <> 'S1'"), "France")


@register(_SRC + " select entity_id from src where src = 'S1'")
def scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tsv.records_of(_src(spark, sf_dir).filter("src = 'S1'"), columns=["entity_id"])


_LISTED = "named as (select distinct unnest(string_split(id_list, ',')) entity_id from lists where trim(id_list) <> '')"


@register(_SRC + "," + fixtures.LISTS_SQL + f", {_LISTED} select s.entity_id, business_name, business_address from src s where src <> 'S1' and s.entity_id in (select entity_id from named)")
def semi_join_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _lists(spark, sf_dir).select(F.explode("ids").alias("entity_id")).distinct()
    return tsv.records_of(tsv.needed(_src(spark, sf_dir).filter("src <> 'S1'"), listed))


@register(_SRC + " select entity_id, business_name, business_address, country from src where src = 'S2' order by entity_id limit 100")
def scan_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 records: a limited scan is what this operator is."""
    return tsv.first_rows(_src(spark, sf_dir).filter("src = 'S2'").select(*tsv.RECORD), 100, ["entity_id"])


@register(_SRC + " select entity_id, business_name, country from src where src = 'S1' and k % 3 <> 0 order by entity_id limit 200")
def train_pool_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 200 records outside a validation set."""
    s = _src(spark, sf_dir).filter("src = 'S1'")
    return tsv.pool_without(s, s.filter("k % 3 = 0"), 200).select("entity_id", "business_name", "country")


@register(_SRC + "," + fixtures.LISTS_SQL + " select s1_id, k, case when trim(id_list) = '' then 0 else len(string_split(id_list, ',')) end n, case when trim(id_list) = '' then '' else array_to_string(list_sort(string_split(id_list, ',')), '|') end ids from lists")
def parse_id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.result_lists(spark, sf_dir).withColumn("ids", tsv.split_list(F.col("id_list")))
    return rows.select("s1_id", "k", F.size("ids").cast("long").alias("n"), F.array_join(F.array_sort("ids"), "|").alias("ids"))


@register(_SRC + "," + fixtures.LISTS_SQL + " select distinct trim(s1_id) entity_id from lists where trim(s1_id) <> ''")
def id_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tsv.id_set(fixtures.result_lists(spark, sf_dir).withColumnRenamed("s1_id", "entity_id"))


@register(_MATCHED + " select s.entity_id source1_entity_id, coalesce(string_agg(t_id, ',' order by prob desc, t_id), '') matched_entity_ids from src s left join found f on f.s1_id = s.entity_id where s.src = 'S1' group by 1")
def sink_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, s, _ = _scored(spark, sf_dir)
    lists = decide.match_lists(s, decide.matches(scored, decide.PIPELINE), [-F.col("prob")])
    return tsv.sink_rows(s, lists, "matched", "matched_entity_ids", position="k")


@register(_SRC + " select entity_id, nullif(business_name, 'NA') business_name, business_address, country from src")
def scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records through a TSV file: missing values come back as nulls."""
    path = scratch_dir(spark, "records")
    tsv.write_tsv(_src(spark, sf_dir).select(*tsv.RECORD), path)
    return tsv.read_typed(spark, path)


@register(_SRC + " select entity_id, coalesce(business_name, '') business_name, coalesce(business_address, '') business_address from src where country = 'India'")
def scan_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a country from bare lines: missing values are empty texts."""
    path = scratch_dir(spark, "records")
    tsv.write_lists(_src(spark, sf_dir).select(*tsv.RECORD), path)
    return tsv.records_of(tsv.read_raw(spark, path), "India")


@register(_SRC + " select country, count(*) n, round(count(*) / sum(count(*)) over (), 9) share from src where src = 'S1' group by 1")
def sink_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country counts through a JSON file."""
    path = scratch_dir(spark, "counts")
    tsv.write_json(country_counts(spark, sf_dir), path)
    return spark.read.schema("country string, n long, share double").json(path)


# Validation of result files

_HEAD = "source1_entity_id\tmatched_entity_ids\n"
#: Files by case, and the words by which the validator's first error is known (none: the file is fine).
FILE_CASES = {
    "fine": (_HEAD + "S1-1\tS2-1\n", ""),
    "empty": ("", "is empty"),
    "commas": ("source1_entity_id,matched_entity_ids\nS1-1,S2-1\n", "tab-separated"),
    "header": ("s1\tmatched\nS1-1\tS2-1\n", "the header is"),
    "malformed": (_HEAD + "S1-1\tS2-1\nno tab\n", "line 3: no tab"),
    "repeated header": (_HEAD + _HEAD + "S1-1\tS2-1\n", "prefix"),
    "not text": (_HEAD + "S1-1\tS2-\udcff\n", "UTF-8"),
    "missing": (None, "file not found"),
}


@register("select * from (values " + ", ".join(f"('{case}', {str(not says).lower()}, true)" for case, (_, says) in FILE_CASES.items()) + ") v(file_case, passes, says_why)")
def val_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validator on a file for each thing that can be wrong with a whole file or a line."""
    folder, rows = scratch_dir(spark, "cases"), []
    required = spark.createDataFrame([("S1-1",)], "entity_id string")
    for case, (text, says) in FILE_CASES.items():
        path = f"{folder}/{case.replace(' ', '-')}.tsv"
        if text is not None:
            write_bytes(spark, path, text.encode("utf-8", "surrogateescape"))
        out = validate.validate(spark, path, required)
        rows.append((case, out.ok, not says or says in out.errors[0]))
    return spark.createDataFrame(rows, "file_case string, passes boolean, says_why boolean")


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.parse_ids(fixtures.result_lists(spark, sf_dir), "s1_id", "id_list")


_FILE = _SRC + "," + fixtures.LISTS_SQL + ", p as (select s1_id, case when trim(id_list) = '' then []::varchar[] else string_split(id_list, ',') end ids, case when trim(candidate_list) = '' then []::varchar[] else string_split(candidate_list, ',') end cids from lists), m as (select distinct unnest(ids) id from p)"
_RULES = {
    "dup_rows": "select s1_id id from p group by 1 having count(*) > 1",
    "intra_dupes": "select distinct s1_id id from p where len(ids) <> len(list_distinct(ids))",
    "self_match": "select id from m where starts_with(id, 'S1-')",
    "wrong_prefix": "select id from m where not starts_with(id, 'S1-') and not starts_with(id, 'S2-') and not starts_with(id, 'S3-')",
    "unknown": "select id from m where (starts_with(id, 'S2-') or starts_with(id, 'S3-')) and id not in (select entity_id from src where src <> 'S1')",
    "missing": "select entity_id id from src where src = 'S1' and entity_id not in (select s1_id from p)",
    "unexpected": "select distinct s1_id id from p where s1_id not in (select entity_id from src where src = 'S1')",
    "subset": "select distinct s1_id id from (select s1_id, unnest(ids) t_id from p) a where not exists (select 1 from (select s1_id, unnest(cids) t_id from p) c where c.s1_id = a.s1_id and c.t_id = a.t_id)",
}


def _rule_query(rule: str, needs: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, src = _lists(spark, sf_dir), _src(spark, sf_dir)
        more = {"": [], "s1": [src.filter("src = 'S1'")], "t": [src.filter("src <> 'S1'")], "c": [validate.parse_ids(fixtures.result_lists(spark, sf_dir), "s1_id", "candidate_list")]}[needs]
        return getattr(validate, rule)(rows, *more)

    query.__name__ = f"val_{rule}"
    register(f"{_FILE} {_RULES[rule]}")(query)


for _rule, _needs in {"dup_rows": "", "intra_dupes": "", "self_match": "", "wrong_prefix": "", "unknown": "t", "missing": "s1", "unexpected": "s1", "subset": "c"}.items():
    _rule_query(_rule, _needs)


@register(_FILE + ", o as (" + " union all ".join(f"select '{r}' as rule, id from ({q})" for r, q in _RULES.items()) + "), k as (select *, row_number() over (partition by rule order by id) r from o) select rule, count(*) n_offenders, string_agg(id, ', ' order by id) filter (where r <= 5) examples from k group by 1")
def val_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _src(spark, sf_dir)
    candidates = validate.Lists(validate.parse_ids(fixtures.result_lists(spark, sf_dir), "s1_id", "candidate_list"))
    found = validate.offenders(validate.Lists(_lists(spark, sf_dir)), src.filter("src = 'S1'"), src.filter("src <> 'S1'"), candidates)
    return validate.report(found)


@register(_FILE + " select count(*) n_rows, count(*) filter (where len(ids) = 0) n_empty, count(*) filter (where len(ids) > 0) n_filled from p")
def val_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.list_counts(_lists(spark, sf_dir))
