"""Scratch tables, names and slices that the operators share."""

from __future__ import annotations

import time
from pathlib import Path
from types import SimpleNamespace

import pytest

from millrace.llm import common as C


def path_of(df):
    return Path(df.scratch_path.removeprefix("file://"))


def test_scratch_tables_go_when_no_longer_needed(spark):
    mark = C.written()
    a, b = (C.materialize(spark.range(n), f"t{n}") for n in (3, 5))
    assert path_of(a).exists() and b.count() == 5
    C.release(spark, mark, b)
    assert not path_of(a).exists() and path_of(b).exists() and b.count() == 5
    C.release(spark, mark)
    assert not path_of(b).exists() and C.written() == mark


def test_shuffle_files_go_with_the_step_that_wrote_them(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().endswith(".data")}

    mark, before = C.written(), shuffled()
    df = spark.range(10_000).selectExpr("id % 100 as k").groupBy("k").count()
    held = [C.materialize(df, "counts"), df]  # what might be collected as garbage is still in use
    until = time.monotonic() + 10
    while (left := shuffled() - before) and time.monotonic() < until:
        time.sleep(0.1)
    assert not left and held[0].count() == held[1].count() == 100
    C.release(spark, mark)


def test_no_local_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda *_: None)
    far = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://somewhere:7077", getConf=lambda: conf))
    with pytest.raises(RuntimeError, match="checkpoint"):
        C.shared_dir(far)
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: "hdfs://shared/x/"))
    assert C.shared_dir(named) == "hdfs://shared/x"


def test_free_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "did int, _DID int, n int")
    assert C.free_names(df, "did", "tid", "n", "n") == ["__did", "tid", "_n", "__n"]


def test_byte_slices():
    texts = ["aa", None, "b" * 10, "", "cc"]
    assert list(C.byte_slices(texts, 4)) == [["aa", None], ["b" * 10], ["", "cc"]]
    assert list(C.byte_slices(texts, 100, rows=2)) == [["aa", None], ["b" * 10, ""], ["cc"]]
    assert list(C.byte_slices([], 4)) == []
