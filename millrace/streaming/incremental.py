"""Linking of target records that arrive as a stream.

References are static; each micro-batch of targets runs through the same plan
as a batch does. The hot-key cap then counts the postings of one micro-batch,
so a trigger should bring enough records for the cap to mean something.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.text import normalize
from millrace.operators.blocking import MAX_CANDIDATES, MAX_POSTINGS, generate_candidates
from millrace.operators.decide import PIPELINE, Thresholds
from millrace.operators.model import Scorer
from millrace.plans.resolve import kept, score_pairs


def link_stream(
    targets: DataFrame, references: DataFrame, path: str, scorer: Scorer | None = None, at: Thresholds = PIPELINE, max_postings: int = MAX_POSTINGS, k: int = MAX_CANDIDATES
) -> DataStreamWriter:
    """A writer that appends ``batch, s1_id, t_id, prob`` of pairs at or above ``at.tau`` to Parquet below ``path``.

    A batch is written to a folder of its own and replaced if it runs again, so
    results are the same after a restart. The no-match guard needs all pairs of
    an entity: apply :func:`millrace.operators.decide.matches` to what is read back.
    """
    s = kept(normalize(references))

    def link(batch: DataFrame, number: int) -> None:
        t = kept(normalize(batch))
        pairs = score_pairs(generate_candidates(s, t, max_postings, k), s, t, scorer)
        found = pairs.filter(F.col("prob") >= at.tau).select("s1_id", "t_id", "prob")
        found.write.mode("overwrite").parquet(f"{path}/batch={number}")
        t.unpersist()

    return targets.writeStream.foreachBatch(link)
