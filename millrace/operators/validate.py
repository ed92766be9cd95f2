"""Checks of result files: every rule as offenders in a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.sources.scratch import exists
from millrace.sources.tsv import numbered_lines, read_raw

MATCHING = ["source1_entity_id", "matched_entity_ids"]
CANDIDATES = ["source1_entity_id", "candidate_entity_ids"]
EXAMPLES = 5

#: Rules in the order of a report, with what they say about an offender.
RULES = {
    "malformed": "the row has no tab",
    "dup_rows": "the S1 entity has more than one row",
    "intra_dupes": "an id is repeated in the list",
    "self_match": "a Source-1 id is listed",
    "wrong_prefix": "an id has no S2-/S3- prefix",
    "unknown": "an id is in neither target source",
    "missing": "a required S1 entity has no row",
    "unexpected": "the S1 entity is not one of the required",
    "subset": "a match is not among the candidates",
}


@dataclass
class Lists:
    """A parsed file: ``rows`` (s1_id, ids array) and ``malformed`` lines (id: the line's number and text)."""

    rows: DataFrame
    malformed: DataFrame | None = None


def parse_ids(rows: DataFrame, id_col: str, list_col: str) -> DataFrame:
    """``s1_id, ids``; a blank list is empty, a trailing comma leaves an empty id."""
    ids = F.when(F.trim(F.coalesce(F.col(list_col), F.lit(""))) == "", F.array().cast("array<string>")).otherwise(F.split(list_col, ","))
    return rows.select(F.col(id_col).alias("s1_id"), ids.alias("ids"))


def _ids(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("ids").alias("id")).distinct()


def dup_rows(rows: DataFrame) -> DataFrame:
    return rows.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("s1_id").alias("id"))


def intra_dupes(rows: DataFrame) -> DataFrame:
    return rows.filter(F.size("ids") != F.size(F.array_distinct("ids"))).select(F.col("s1_id").alias("id")).distinct()


def self_match(rows: DataFrame) -> DataFrame:
    return _ids(rows).filter(F.col("id").startswith("S1-"))


def wrong_prefix(rows: DataFrame) -> DataFrame:
    return _ids(rows).filter(~F.col("id").rlike("^S[123]-"))


def unknown(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets``: the ids (entity_id) that exist."""
    return _ids(rows).filter(F.col("id").rlike("^S[23]-")).join(targets.select(F.col("entity_id").alias("id")), "id", "left_anti")


def missing(rows: DataFrame, required: DataFrame) -> DataFrame:
    return required.select(F.col("entity_id").alias("id")).distinct().join(rows.select(F.col("s1_id").alias("id")), "id", "left_anti")


def unexpected(rows: DataFrame, required: DataFrame) -> DataFrame:
    return rows.select(F.col("s1_id").alias("id")).distinct().join(required.select(F.col("entity_id").alias("id")), "id", "left_anti")


def subset(matching: DataFrame, candidates: DataFrame) -> DataFrame:
    """Entities with a match that is no candidate of theirs (a warning, not an error)."""
    pairs = lambda x: x.select("s1_id", F.explode("ids").alias("t_id"))
    return pairs(matching).join(pairs(candidates), ["s1_id", "t_id"], "left_anti").select(F.col("s1_id").alias("id")).distinct()


def offenders(lists: Lists, required: DataFrame, targets: DataFrame | None = None, candidates: Lists | None = None) -> DataFrame:
    """``rule, id`` of everything that breaks a rule; ids of targets are only looked up if ``targets`` is given."""
    found = {
        "dup_rows": dup_rows(lists.rows),
        "intra_dupes": intra_dupes(lists.rows),
        "self_match": self_match(lists.rows),
        "wrong_prefix": wrong_prefix(lists.rows),
        "missing": missing(lists.rows, required),
        "unexpected": unexpected(lists.rows, required),
    }
    if lists.malformed is not None:
        found["malformed"] = lists.malformed
    if targets is not None:
        found["unknown"] = unknown(lists.rows, targets)
    if candidates is not None:
        found["subset"] = subset(lists.rows, candidates.rows)
    out = None
    for rule, ids in found.items():
        part = ids.select(F.lit(rule).alias("rule"), "id")
        out = part if out is None else out.unionByName(part)
    return out


def report(found: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """``rule, n_offenders, examples`` (the first in order, comma-joined).

    ``found`` is read twice, so that only ``examples`` rows of a rule meet in one task: keep it if it is dear.
    """
    first = found.withColumn("k", F.row_number().over(Window.partitionBy("rule").orderBy("id"))).filter(F.col("k") <= examples)
    shown = first.groupBy("rule").agg(F.array_join(F.array_sort(F.collect_list("id")), ", ").alias("examples"))
    return found.groupBy("rule").agg(F.count(F.lit(1)).alias("n_offenders")).join(shown, "rule")


def list_counts(rows: DataFrame) -> DataFrame:
    """One row: ``n_rows, n_empty, n_filled``."""
    empty = F.size("ids") == 0
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(empty).alias("n_empty"), F.count_if(~empty).alias("n_filled"))


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def read_lists(spark: SparkSession, path: str, header: list[str]) -> tuple[Lists | None, list[str]]:
    """Parse a tab-separated id-list file as text; errors that stop the parsing come as messages.

    The header is the first line of a file (of each, if the path is a folder); the same text further down is a row.
    """
    name = _name(path)
    if not exists(spark, path):
        return None, [f"{name}: file not found"]
    try:
        lines = numbered_lines(spark, path)
        heads = [r.value for r in lines.filter("line = 1").select("value").distinct().limit(2).collect()]
        if not heads:
            return None, [f"{name}: the file is empty"]
        if lines.filter(~F.is_valid_utf8("value")).limit(1).count():
            return None, [f"{name}: the file is not valid UTF-8 text"]
    except PySparkException as e:
        return None, [f"{name}: could not be read: {str(e).splitlines()[0]}"]
    for head in heads:
        if "\t" not in head and "," in head:
            return None, [f"{name}: the header has commas and no tab; the file must be tab-separated"]
        found = [c.strip().lower() for c in head.split("\t")]
        if found != header:
            return None, [f"{name}: the header is {found}, not {header}"]
    body = lines.filter("line > 1")
    tab = F.instr("value", "\t")
    rows = body.filter(tab > 0).select(F.substring_index("value", "\t", 1).alias("s1"), F.expr("substring(value, instr(value, '\t') + 1)").alias("list"))
    malformed = body.filter((tab == 0) & (F.trim("value") != "")).select(F.format_string("line %d: %s", "line", F.rtrim("value")).alias("id"))
    return Lists(parse_ids(rows, "s1", "list"), malformed), []


@dataclass
class Outcome:
    """What a validation found; ``counts`` are rows, empty and filled lists by file."""

    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    counts: dict[str, tuple[int, int, int]] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return not self.errors

    def text(self) -> str:
        lines = [f"{name}: {n} rows ({empty} empty, {filled} non-empty)" for name, (n, empty, filled) in self.counts.items()]
        lines += [f"WARNING: {w}" for w in self.warnings]
        lines += ["PASS" if self.ok else f"FAIL, {len(self.errors)} to mend:", *(f"  {k}. {e}" for k, e in enumerate(self.errors, 1))]
        return "\n".join(lines)


def validate(spark: SparkSession, matching_path: str, required: DataFrame, candidate_path: str | None = None, targets: DataFrame | None = None) -> Outcome:
    """Check a matching file, and a candidate file if there is one, against the required entities (and known targets)."""
    out = Outcome()
    if targets is None:
        out.warnings.append("whether listed ids exist was not checked")
    matching, stop = read_lists(spark, matching_path, MATCHING)
    out.errors += stop
    candidates = None
    if candidate_path and not exists(spark, candidate_path):
        out.warnings.append(f"{_name(candidate_path)} not found: candidates were not checked")
    elif candidate_path:
        candidates, stop = read_lists(spark, candidate_path, CANDIDATES)
        out.errors += stop
    for path, lists in ((matching_path, matching), (candidate_path, candidates)):
        if lists is None:
            continue
        name = _name(str(path))
        out.counts[name] = tuple(list_counts(lists.rows).first())
        found = offenders(lists, required, targets).persist(StorageLevel.MEMORY_AND_DISK)
        told = {r.rule: r for r in report(found).collect()}  # a row per rule
        found.unpersist()
        out.errors += [f"{name}: {RULES[k]}: {told[k].n_offenders}, e.g. {told[k].examples}" for k in RULES if k in told]
    if matching is not None and candidates is not None:
        for r in report(subset(matching.rows, candidates.rows).select(F.lit("subset").alias("rule"), "id")).collect():
            out.warnings.append(f"{RULES['subset']}: {r.n_offenders}, e.g. {r.examples}")
    return out


def validate_files(spark: SparkSession, matching_path: str, test_dir: str, candidate_path: str | None = None, check_ids: bool = False) -> Outcome:
    """The same, with the required entities and, on demand, the known targets from the source files in ``test_dir``.

    A missing target file turns the look-up off, with a warning; a missing reference file is an error.
    """
    source, *others = (f"{test_dir}/test_source{k}.tsv" for k in (1, 2, 3))
    if not exists(spark, source):
        return Outcome([f"{source}: file not found"])
    targets, lost = None, [p for p in others if check_ids and not exists(spark, p)]
    if check_ids and not lost:
        targets = read_raw(spark, others[0], ["entity_id"]).unionByName(read_raw(spark, others[1], ["entity_id"]))
    out = validate(spark, matching_path, read_raw(spark, source, ["entity_id"]), candidate_path, targets)
    out.warnings += [f"{p} not found: ids were not looked up" for p in lost]
    return out
