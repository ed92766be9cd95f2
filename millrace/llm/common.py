"""Helpers shared by the training-data operators.

Conventions of the subpackage:

* Operators are functions ``DataFrame -> DataFrame``; they address their input
  columns by name and ignore all others. Helper columns that stand beside the
  input's own get names the input does not have (:func:`free_names`).
* A result that is read more than once, or whose lineage must be cut, is
  written as Parquet below ``spark.checkpoint.dir`` (:func:`materialize`), which
  every executor can read again after another one is lost. What a step no longer
  needs it deletes (:func:`release`).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Set here once per process where a local session names no shared folder (tests).
_fallback_dir: list[str] = []
#: What this process has materialised and not released, oldest first.
_written: list[str] = []

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

_SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Leading bits of a hash that name the cell in which it is counted, to find where a sample ends.
_SAMPLE_BITS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver's. One that is in fewer files than there are cores is dealt over them: a file of one row
    group would be one task all through the first stage."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Unset, a temporary one in a local session and an error elsewhere."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _fallback_dir:
        _fallback_dir.append(tempfile.mkdtemp(prefix="millrace-"))
    return "file://" + _fallback_dir[0]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    with _shuffles_end(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


@contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    """What is executed here deletes its shuffle files when it ends. Else they stay until the driver happens to collect
    its garbage, and those of all steps add up."""
    before = spark.conf.get(_SHUFFLES_END, None)
    spark.conf.set(_SHUFFLES_END, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_END)
        else:
            spark.conf.set(_SHUFFLES_END, before)


def written() -> int:
    """A mark for :func:`release`: how much has been materialised so far."""
    return len(_written)


def release(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Delete what was materialised after the mark ``since``, but for ``keep`` (as :func:`materialize` returned them)."""
    kept = {df.scratch_path for df in keep}
    for path in [p for p in _written[since:] if p not in kept]:
        _delete(spark, path)
        _written.remove(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete everything this application has materialised. Call it when no result is still needed."""
    _delete(spark, f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}")
    _written.clear()


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes not to be a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_hash(text: Column) -> Column:
    """A hash of the whole text; a null text counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key is in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def ascii_lower(s: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII strings, the common case, take the fast path."""
    return F.when(F.octet_length(s) == F.length(s), F.lower(s)).otherwise(F.translate(s, UPPER, LOWER))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows``, so that only so many texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def byte_slices(texts: Iterable[str | None], most: int, rows: int = 500) -> Iterator[list[str | None]]:
    """The texts in lists of at most ``rows`` texts and about ``most`` characters (one text at least)."""
    held: list[str | None] = []
    size = 0
    for text in texts:
        if held and (len(held) >= rows or size + len(text or "") > most):
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text or "")
    if held:
        yield held


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hashed_sample(df: DataFrame, max_rows: int, columns: list[str] | None = None, stratum: str | None = None) -> DataFrame:
    """At most ``max_rows`` rows (of each value of ``stratum``), those of the smallest hashes of the whole row (or of
    ``columns``): the same rows whatever their order, and ``max_rows`` of them where there are more.

    Different hashes are counted by cells first, which tells up to which cell rows are needed; only those are sorted.
    Rows of one hash are alike in all hashed columns. What is broadcast is a row for each stratum.
    """
    k, cell, n, last, of = free_names(df, "sample_key", "sample_cell", "sample_n", "sample_last", "sample_of")
    own = F.lit(0) if stratum is None else F.col(stratum)
    keyed = df.withColumns({k: F.xxhash64(F.lit(11), *(F.col(c) for c in columns or df.columns)), of: own})
    keyed = keyed.withColumn(cell, F.shiftright(k, 64 - _SAMPLE_BITS))  # cells in the order of the hashes
    cells = keyed.groupBy(of, cell).agg(F.approx_count_distinct(k).alias(n))
    before = F.sum(n).over(Window.partitionBy(of).orderBy(cell)) - F.col(n)
    cuts = cells.withColumn(n, before).filter(F.col(n) < 1.3 * max_rows + 10).groupBy(F.col(of).alias(n)).agg(F.max(cell).alias(last))
    keyed = keyed.join(F.broadcast(cuts), F.col(of).eqNullSafe(F.col(n))).filter(F.col(cell) <= F.col(last))
    if stratum is None:
        return keyed.orderBy(k).limit(max_rows).drop(k, cell, n, last, of)
    rank = F.row_number().over(Window.partitionBy(of).orderBy(k))
    return keyed.withColumn(n, rank).filter(F.col(n) <= max_rows).drop(k, cell, n, last, of)


def within_bytes(sample: DataFrame, text_col: str, max_bytes: int, max_text: int, by: str | None = None, groups: int = 1) -> DataFrame:
    """Of a bounded ``sample`` the rows, smallest hash first, whose whole texts take ``max_bytes`` together (each of the
    ``groups`` of ``by`` its part of that, and the first text at least); texts over ``max_text`` are left out, so that
    one does not stand for many."""
    size, so_far = free_names(sample, "text_bytes", "text_bytes_so_far")
    order = Window.partitionBy(F.lit(0) if by is None else F.col(by)).orderBy(F.xxhash64(F.lit(12), *sample.columns))  # over the sample alone
    sized = sample.withColumn(size, F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")).filter(F.col(size) <= max_text)
    before = F.sum(size).over(order) - F.col(size)
    return sized.withColumn(so_far, before).filter((F.col(so_far) == 0) | (F.col(so_far) + F.col(size) <= max_bytes // groups)).drop(size, so_far)
