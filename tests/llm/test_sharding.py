from __future__ import annotations

from collections import defaultdict

import duckdb
import pytest

from millrace.llm import queries
from millrace.llm import sharding as H

from .conftest import MESSY


def check(rows, limit):
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard, r.page].append(r)
    for (shard, page), part in shards.items():
        size = sum(r.n_bytes for r in part)
        assert size <= limit or len(part) == 1
        assert {(r.shard_bytes, r.shard_docs, r.depth) for r in part} == {(size, len(part), len(shard))}
    names = {s for s, _ in shards}
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    return shards


@pytest.mark.parametrize("limit", [1 << 30, 1000, 60])
def test_messy(messy, limit):
    rows = H.extendible_shards(messy, limit, max_bits=30).collect()
    assert sorted((str(r.doc_id), r.n_bytes) for r in rows) == sorted((str(i), len((t or "").encode())) for i, t in MESSY)
    shards = check(rows, limit)
    assert (len(shards) == 1) == (limit == 1 << 30)


def test_only_oversized_buckets_split(spark):
    df = spark.createDataFrame([(i, "x" * (1000 if i % 50 == 0 else 10)) for i in range(2000)], "doc_id long, text string")
    rows = H.extendible_shards(df, 2000).collect()
    check(rows, 2000)
    size = defaultdict(int)
    for r in rows:
        for d in range(r.depth):
            size[r.shard[:d]] += r.n_bytes
    assert all(n > 2000 for n in size.values())  # every bucket that was split was too large
    assert len({r.depth for r in rows}) > 1


def test_deeper_rounds(spark, monkeypatch):
    monkeypatch.setattr(H, "ROUND_BITS", 2)
    df = spark.createDataFrame([(i, "x" * 10) for i in range(300)], "doc_id long, text string")
    rows = H.extendible_shards(df, 50).collect()
    assert len(rows) == 300 and max(r.depth for r in rows) > 4
    check(rows, 50)


def test_key_that_most_rows_share(spark):
    df = spark.createDataFrame([(1, "y" * 10)] * 500 + [(1, "z" * 70)] + [(i, "x" * 10) for i in range(100)], "doc_id long, text string")
    rows = H.extendible_shards(df, 100, max_bits=24).collect()
    assert len(rows) == 601
    shards = check(rows, 100)
    assert len(shards) <= 2.5 * sum(r.n_bytes for r in rows) / 100 + 40


def test_empty(none):
    assert H.extendible_shards(none, 100).count() == 0


def test_query_and_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.sql(queries.oracle_sql()["op10_extendible_sharding"])
    columns = want.columns
    got = [tuple(r[c] for c in columns) for r in queries.op10_extendible_sharding(spark, sf).collect()]
    assert sorted(got) == sorted(want.fetchall())
