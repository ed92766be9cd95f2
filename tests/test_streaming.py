from __future__ import annotations

from millrace.operators.decide import PIPELINE
from millrace.plans.resolve import resolve
from millrace.sources import fixtures, tsv
from millrace.streaming.incremental import link_stream


def test_stream_finds_what_a_batch_finds(spark, tmp_path):
    src = fixtures.sources(spark, "/root/testdata/sf0.001")
    refs, targets = src.filter("src = 'S1'"), src.filter("src <> 'S1'").select(*tsv.RECORD)
    targets.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(tsv.RECORD_SCHEMA).parquet(str(tmp_path / "in"))
    query = link_stream(stream, refs, str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).start()
    query.processAllAvailable()
    query.stop()
    got = {(r.s1_id, r.t_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r.s1_id, r.t_id) for r in resolve(refs, targets).scored.filter(f"prob >= {PIPELINE.tau}").collect()}
    assert got == want and got
