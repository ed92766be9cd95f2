from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

from millrace.llm import linededup as L
from millrace.llm import queries

from .conftest import MESSY

BLANKS = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows):
    """Kept text, lines and dropped lines of each row."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    where = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            where[key(line)].add(-(1 << 63) if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        mine = -(1 << 63) if doc is None else doc
        kept = [x for x in lines if not (len(key(x)) >= 20 and len(where[key(x)]) >= 3 and max(where[key(x)]) != mine)]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_messy(messy):
    out = L.dedup_lines(messy)
    assert set(out.columns) == {*messy.columns, "n_dropped"}
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect())
    assert got == Counter(plain(MESSY))
    assert sum(r[3] for r in plain(MESSY)) >= 3


def test_many_lines_and_hot_line(spark):
    hot = "This very common line stands in every document."
    rows = [(i, "\n".join([f"own line {i} {j} that nobody else has" if (i + j) % 3 else f"shared line {j} of several texts" for j in range(150)] + [hot])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in L.dedup_lines(df).collect())
    assert got == Counter(plain(rows))
    maps = L.keep_bitmaps(df).collect()
    assert all(set(m.words) <= {0, 1, 2} for m in maps)  # 151 lines are three words of 64


def test_fewer_documents_than_needed(spark):
    rows = [(1, "twice a line of enough characters"), (2, "twice a line of enough characters"), (2, "twice a line of enough characters")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert L.dedup_lines(df).filter("n_dropped > 0").count() == 0


def test_empty(none):
    assert L.dedup_lines(none).count() == 0


def test_no_python_in_the_plan(messy):
    plan = L.dedup_lines(messy)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    sql = con.sql(queries.oracle_sql()["op3_line_dedup"]).fetchall()
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in queries.op3_line_dedup(spark, sf).collect()]
    assert sorted(got) == sorted(sql)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(got) == sorted((d, n, g, hashlib.sha256(t.encode()).hexdigest()) for d, t, n, g in plain(docs))


def test_other_column_names(spark):
    df = spark.createDataFrame([("a", "x")], "name string, body string").select(F.lit(1).alias("id"), F.col("body"))
    assert L.dedup_lines(df, id_col="id", text_col="body").first().n_lines == 1


def test_ids_of_other_types_and_clashing_names(spark):
    rows = [("a", "The same line stands in many documents.\nown"), ("b", "the same line stands in many documents."), ("c", "THE SAME line stands in many documents.\nmine"), (None, "The same line stands in many documents.")]
    df = spark.createDataFrame([(*r, 1, 2, "w") for r in rows], "doc_id string, text string, __did int, __tid int, __words string")
    out = {r.doc_id: (r.text, r.n_dropped, r["__did"], r["__tid"], r["__words"]) for r in L.dedup_lines(df).collect()}
    assert out == {"a": ("own", 1, 1, 2, "w"), "b": ("", 1, 1, 2, "w"), "c": (rows[2][1], 0, 1, 2, "w"), None: ("", 1, 1, 2, "w")}


def test_a_hot_line_is_spread_over_the_ranges(spark):
    """A line of a third of all rows: its rows are dealt over several partitions by the document's hash."""
    from pyspark.sql import functions as F

    hot = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("This very common line stands in every document.\n"), F.col("id").cast("string"), F.lit(" own line of some length\n"), F.col("id").cast("string"), F.lit(" other line of some length")).alias("text"))
    out = L.dedup_lines(hot)
    assert out.filter("n_dropped = 1").count() == 5999 and out.filter("n_dropped = 0").first().doc_id == 5999
