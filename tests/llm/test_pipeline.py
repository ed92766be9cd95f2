"""The pipeline against a plain version of each stage, each on its own input."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from millrace.llm import decontam, queries
from millrace.llm.common import materialize, table

from . import test_linededup, test_nearcopies

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in C.STAGES:
        after = materialize(stage(spark, docs, SF), name)
        out.append((docs, after))
        docs = after
    return dict(zip((n for n, _ in C.STAGES), out, strict=True))


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_order_and_columns(stages):
    assert list(stages) == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality(spark, stages):
    before, after = map(texts, stages["quality"])
    ids = sorted(before)
    scores = queries.quality_model(spark, SF).scores([before[i] for i in ids])
    assert after == {i: before[i] for i, s in zip(ids, scores, strict=True) if s >= 0.5}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    clean = [i for i in ids if labels.get(i) == 1]
    assert sum(i in after for i in clean) >= 0.95 * len(clean)
    assert sum(i in after for i in ids if labels.get(i) == 0) == 0


def test_line_dedup(stages):
    before, after = map(texts, stages["line_dedup"])
    assert after == {i: t for i, t, *_ in test_linededup.plain(sorted(before.items()))}
    assert all(r.n_chars == len(r.text) for r in stages["line_dedup"][1].collect())


def test_near_dedup(stages):
    before, after = map(texts, stages["near_dedup"])
    assert after == {i: before[i] for i in test_nearcopies.plain_kept(sorted(before.items()))}


def test_decontamination(spark, stages):
    before, after = map(texts, stages["decontamination"])
    plain = lambda t: b" " + b" ".join(decontam.words_of(t)) + b" "
    items = [plain(r.text) for r in table(spark, SF, "benchmark").collect()]
    assert after == {i: t for i, t in before.items() if not any(x in plain(t) for x in items)}


def test_packing(stages):
    before, pieces = texts(stages["packing"][0]), stages["packing"][1].collect()
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = set()
    for i, t in before.items():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want |= {(i, p, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())) for p, s in enumerate(range(0, len(ids), 4096))}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces} == want and len(pieces) == len(want)
    end = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == end.get(r.sequence_id, 0)
        end[r.sequence_id] = r.offset + r.length
    assert max(end.values()) <= 4096 and len(end) == -(-sum(r.length for r in pieces) // 4096)


def test_run(spark, stages):
    assert C.run(spark, SF).count() == stages["packing"][1].count()


def test_extra_columns_and_repeated_rows(spark):
    """Stages pass other columns on, whatever their names; of rows alike in id and text one stays, always the same."""
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").limit(40).selectExpr("*", "1 as __did", "2 as __tid", "3 as __id", "'w' as __words", "4 as quality_score", "doc_id % 2 as stay_id", "map('a', 1) as m")
    docs = docs.unionByName(docs.withColumn("__did", docs["__did"] + 1))
    for name, stage in C.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert all(r["__tid"] == 2 and r["quality_score"] == 4 for r in out.collect())
    kept = [sorted((r.doc_id, r["__did"]) for r in C.near_dedup(spark, docs.repartition(n), sf).collect()) for n in (1, 5)]
    assert kept[0] == kept[1] and len({i for i, _ in kept[0]}) == len(kept[0])
