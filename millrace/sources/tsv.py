"""Tab-separated sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RECORD = ["entity_id", "business_name", "business_address", "country"]
RECORD_SCHEMA = StructType([StructField(c, StringType()) for c in RECORD])
TRUTH = ["source1_entity_id", "matched_entity_ids"]
TRUTH_SCHEMA = StructType([StructField(c, StringType()) for c in TRUTH])

# Texts that a typed reader takes for missing ones.
NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_typed(spark: SparkSession, path: str, schema: StructType = RECORD_SCHEMA, na_values: list[str] | None = None) -> DataFrame:
    """A quoted TSV with a header, all columns text; values of ``na_values`` (by default :data:`NA_VALUES`) are null."""
    na = NA_VALUES if na_values is None else na_values
    rows = spark.read.schema(schema).csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=False)
    return rows.select(*(F.when(F.col(c).isin(na), None).otherwise(F.col(c)).alias(c) for c in rows.columns))


def first_line(spark: SparkSession, path: str) -> str | None:
    """None for a file without any line."""
    first = spark.read.text(path).limit(1).collect()
    return first[0].value if first else None


def body_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the lines but for the first of each file, wherever else its text stands. Empty lines are left out.

    The CSV reader drops a header by its position; with a separator that no text holds a line is one cell.
    """
    return spark.read.schema("value string").csv(path, sep="\x01", header=True, quote="", escape="", multiLine=False)


def read_raw(spark: SparkSession, path: str, columns: list[str] = RECORD) -> DataFrame:
    """A TSV as bare lines: quotes are text, "NA" is a value, short rows are skipped, columns go by the header's names.

    Rows are located by the header, so a file may have more columns in any order.
    """
    head = first_line(spark, path)
    if head is None:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns]))
    names = [c.strip().lower() for c in head.split("\t")]
    at = [names.index(c) for c in columns]
    cells = F.split("value", "\t")
    rows = body_lines(spark, path).filter(F.size(cells) > max(at))
    return rows.select(*(cells[i].alias(c) for i, c in zip(at, columns, strict=True)))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, value``: every line with its number in its file, from 1.

    Lines of a block of a file stand together in a partition, in order, so a line's number is its distance from the
    block's first line, plus the lines of the blocks before: a first pass counts those. What is broadcast is a row for
    each block.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    blocks = raw.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = F.broadcast(blocks.select("file", "block", (before - F.col("first") + 1).alias("shift")))
    return raw.join(blocks, ["file", "block"]).select("file", (F.col("at") + F.col("shift")).alias("line"), "value")


def records_of(rows: DataFrame, country: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Filter and projection that the optimizer pushes into the scan."""
    if country is not None:
        rows = rows.filter(F.col("country") == country)
    return rows.select(*(columns or ["entity_id", "business_name", "business_address"]))


def needed(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The records whose id is among ``ids`` (entity_id)."""
    return rows.join(ids.select("entity_id"), "entity_id", "left_semi")


def first_rows(rows: DataFrame, n: int, order: list[str]) -> DataFrame:
    """A limited scan made deterministic by an order."""
    return rows.orderBy(*order).limit(n)


def pool_without(rows: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records by id that are not among ``ids``."""
    return first_rows(rows.join(ids.select("entity_id"), "entity_id", "left_anti"), n, ["entity_id"])


def id_set(rows: DataFrame, column: str = "entity_id") -> DataFrame:
    trimmed = F.trim(column)
    return rows.select(trimmed.alias(column)).filter(F.col(column) != "").distinct()


def split_list(cell: Column) -> Column:
    """A comma-joined cell as an array; a blank or missing one is empty."""
    return F.when(F.trim(F.coalesce(cell, F.lit(""))) == "", F.array().cast("array<string>")).otherwise(F.split(cell, ","))


def parse_truth(rows: DataFrame) -> DataFrame:
    """``s1_id, ids``."""
    return rows.select(F.col("source1_entity_id").alias("s1_id"), split_list(F.col("matched_entity_ids")).alias("ids"))


def truth_pairs(parsed: DataFrame) -> DataFrame:
    return parsed.select("s1_id", F.explode("ids").alias("t_id")).distinct()


def sink_rows(references: DataFrame, lists: DataFrame, list_col: str, out_col: str, position: str | None = None) -> DataFrame:
    """``source1_entity_id`` and the comma-joined list of every reference (empty for none), in input order if ``position`` names it."""
    keep = ["entity_id", *([position] if position else [])]
    rows = references.select(*keep).join(lists.select(F.col("s1_id").alias("entity_id"), list_col), "entity_id", "left")
    if position:
        rows = rows.orderBy(position)
    return rows.select(F.col("entity_id").alias("source1_entity_id"), F.concat_ws(",", F.coalesce(list_col, F.array().cast("array<string>"))).alias(out_col))


def write_lists(rows: DataFrame, path: str) -> None:
    """Unquoted, tab-separated, with a header; a list without ids is an empty cell."""
    rows.write.mode("overwrite").csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="")


def write_tsv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, sep="\t", header=True, quote="\"", escape="\"", emptyValue="", nullValue="")


def write_json(row: DataFrame, path: str) -> None:
    row.write.mode("overwrite").json(path)


def assert_unique(rows: DataFrame, column: str = "entity_id") -> DataFrame:
    """``rows``, or an error that names an id held twice (it would count twice in every score)."""
    twice = rows.groupBy(column).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{column} is not unique: {twice[0][0]}")
    return rows
