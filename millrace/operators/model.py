"""Scorers: features in, ``prob`` out. What follows a scorer does not know which one it was."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import boost, whole
from .decide import DEFAULT, Thresholds
from .features import FEATURE_NAMES

#: Leading bits of a hash that name the cell in which it is counted.
_CELL_BITS = 12
#: Parts in which a sample comes to the driver.
_PARTS = 16


class Scorer(Protocol):
    def score(self, features: DataFrame) -> DataFrame:
        """``features`` with a column ``prob``."""


class Scorecard:
    """A fixed logistic model over features that SQL can express, so that the whole chain can be checked in SQL."""

    BIAS = -4.0
    WEIGHTS = {"name_token_jaccard": 3.0, "name_char3gram_jaccard": 3.0, "name_compact_match": 1.5, "addr_token_jaccard": 1.5, "postal_exact_match": 1.0, "postal_mismatch": -1.0, "number_match": 1.0}

    def score(self, features: DataFrame) -> DataFrame:
        z = F.lit(self.BIAS)
        for name, weight in self.WEIGHTS.items():
            z = z + F.lit(weight) * F.col(name)
        return features.withColumn("prob", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))


def _gather(rows: DataFrame, max_pairs: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Features (four bytes each, as precise as they are stored elsewhere) and labels of the ``max_pairs`` rows of the
    smallest hashes, in their order.

    Hashes are counted by cells first, so that hardly more rows than that come to the driver, as packed arrays: sorting
    for the first rows would send the driver as many of every partition.
    """
    columns = [*FEATURE_NAMES, "label", *(c for c in ("s1_id", "t_id") if c in rows.columns)]
    keyed = rows.withColumn("__k", F.xxhash64(F.lit(seed), *(F.col(c) for c in columns)))
    cell = F.shiftright("__k", 64 - _CELL_BITS)  # cells in the order of the hashes
    before, last = 0, -(1 << _CELL_BITS)
    for at, n in sorted((r["cell"], r["n"]) for r in keyed.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()):
        if before >= max_pairs:
            break
        before, last = before + n, at

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, label, *x = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            parts = key.astype(np.int64), label.astype(np.float32), np.stack(x, 1).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["key", "label", "x"])

    wanted = keyed.filter(cell <= last).select("__k", F.col("label").cast("float"), *(F.col(n).cast("float") for n in FEATURE_NAMES))
    packed = list(wanted.mapInArrow(pack, "key binary, label binary, x binary").repartition(_PARTS).toLocalIterator())  # the JVM holds a part at a time
    key, label, x = (np.frombuffer(b"".join(r[c] for r in packed), kind) for c, kind in (("key", np.int64), ("label", np.float32), ("x", np.float32)))
    order = np.argsort(key, kind="stable")[:max_pairs]
    return x.reshape(-1, len(FEATURE_NAMES))[order], label[order].astype(float)


class BoostedTrees:
    """Gradient-boosted trees on all features, with the thresholds they are used with."""

    def __init__(self, model: boost.Boosted | None = None, thresholds: Thresholds = DEFAULT) -> None:
        self.model, self.thresholds = model, thresholds

    def fit(
        self,
        labelled: DataFrame,
        rounds: int = 300,
        rate: float = 0.06,
        leaves: int = 31,
        depth: int = 6,
        seed: int = 42,
        valid: DataFrame | None = None,
        patience: int = 50,
        max_pairs: int | None = None,
    ) -> BoostedTrees:
        """On all rows; only a caller that gives ``max_pairs`` has a sample. With ``valid`` rows boosting ends when their loss
        has not fallen for ``patience`` rounds."""
        if max_pairs is None:
            self.model = whole.fit(labelled, FEATURE_NAMES, rounds, rate, leaves, depth, valid=valid, patience=patience, seed=seed)
            return self
        x, y = _gather(labelled, max_pairs, seed)
        held = None if valid is None else _gather(valid, max_pairs, seed)
        self.model = boost.fit(x, y, rounds, rate, leaves, depth, valid=held, patience=patience, seed=seed)
        return self

    def _fitted(self) -> boost.Boosted:
        if self.model is None:
            raise RuntimeError("the model has not been fitted")
        return self.model

    def score(self, features: DataFrame) -> DataFrame:
        shared = features.sparkSession.sparkContext.broadcast(self._fitted())  # rounds times leaves nodes

        @F.pandas_udf(DoubleType())
        def prob(*columns: pd.Series) -> pd.Series:
            x = np.stack([c.to_numpy(np.float32) for c in columns], 1).astype(float)
            return pd.Series(shared.value.probabilities(x))

        return features.withColumn("prob", prob(*(F.col(n).cast("float") for n in FEATURE_NAMES)))

    def importances(self, top: int = 10) -> list[tuple[str, float]]:
        """What the splits on a feature gained in all, the largest first."""
        return sorted(zip(FEATURE_NAMES, self._fitted().gains, strict=True), key=lambda x: (-x[1], x[0]))[:top]

    def save(self, spark: SparkSession, path: str) -> None:
        """One line of JSON below ``path``, on any file system that Spark writes to."""
        model = self._fitted()
        whole = {"base": model.base, "trees": [asdict(t) for t in model.trees], "gains": model.gains, "thresholds": asdict(self.thresholds)}
        spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, *paths: str) -> BoostedTrees:
        """From the first of ``paths`` that exists."""
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
                whole = json.loads(spark.read.text(path).first().value)
                model = boost.Boosted(whole["base"], [boost.Tree(**t) for t in whole["trees"]], whole["gains"])
                return cls(model, Thresholds(**whole["thresholds"]))
        raise FileNotFoundError(f"no model at {' or '.join(paths)}")
