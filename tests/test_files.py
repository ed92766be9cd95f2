"""Sources, sinks and the validator on real files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import validate as V
from millrace.plans.resolve import evaluate, rescore, resolve
from millrace.sources import fixtures, tsv


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_readers(spark, tmp_path):
    path = write(tmp_path / "s.tsv", 'entity_id\tbusiness_name\tbusiness_address\tcountry\textra\nS2-1\tNA\t"1 Oak"\tUS\tx\nS2-2\tFoo\nS2-3\tBar\t\tUS\ty\n')
    raw = {r.entity_id: r for r in tsv.read_raw(spark, path).collect()}
    assert set(raw) == {"S2-1", "S2-3"} and raw["S2-1"].business_name == "NA" and raw["S2-1"].business_address == '"1 Oak"'
    typed = {r.entity_id: r for r in tsv.read_typed(spark, path).collect()}
    assert typed["S2-1"].business_name is None and typed["S2-1"].business_address == "1 Oak" and typed["S2-2"].country is None
    with pytest.raises(ValueError):
        tsv.assert_unique(spark.createDataFrame([("a",), ("a",)], "entity_id string"))


def test_lists_round_trip(spark, tmp_path):
    refs = spark.createDataFrame([("S1-2", 0), ("S1-1", 1)], "entity_id string, pos int")
    lists = spark.createDataFrame([("S1-1", ["S2-1", "S3-2"])], "s1_id string, matched array<string>")
    rows = tsv.sink_rows(refs, lists, "matched", "matched_entity_ids", "pos")
    tsv.write_lists(rows.coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text()
    assert text == "source1_entity_id\tmatched_entity_ids\nS1-2\t\nS1-1\tS2-1,S3-2\n"
    back = tsv.parse_truth(tsv.read_raw(spark, str(tmp_path / "out"), tsv.TRUTH)).collect()
    assert {r.s1_id: r.ids for r in back} == {"S1-2": [], "S1-1": ["S2-1", "S3-2"]}


def required(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "entity_id string")


HEAD = "source1_entity_id\tmatched_entity_ids\n"


@pytest.mark.parametrize(
    ("body", "rule"),
    [
        ("S1-1\tS2-1\nbroken\n", "malformed"),
        ("S1-1\tS2-1\nS1-1\t\n", "dup_rows"),
        ("S1-1\tS2-1,S2-1\n", "intra_dupes"),
        ("S1-1\tS1-1\n", "self_match"),
        ("S1-1\tS2-1,\n", "wrong_prefix"),
        ("S1-1\tS2-9\n", "unknown"),
        ("", "missing"),
        ("S1-1\t\nS1-2\t\n", "unexpected"),
    ],
)
def test_rules(spark, tmp_path, body, rule):
    path = write(tmp_path / "m.tsv", HEAD + body)
    errors = V.validate(spark, path, required(spark, "S1-1"), targets=required(spark, "S2-1")).errors
    assert len(errors) == 1 and V.RULES[rule] in errors[0]


def test_headers_and_clean_file(spark, tmp_path):
    need = required(spark, "S1-1")
    good = write(tmp_path / "m.tsv", HEAD + "S1-1\tS2-1\n")
    cands = write(tmp_path / "c.tsv", "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-2\n")
    out = V.validate(spark, good, need, cands)
    assert out.ok and any(V.RULES["subset"] in w for w in out.warnings)
    assert out.counts == {"m.tsv": (1, 0, 1), "c.tsv": (1, 0, 1)} and out.text().endswith("PASS")
    for text, says in (("a,b\n", "tab-separated"), ("x\ty\n", "header"), ("", "empty")):
        errors = V.validate(spark, write(tmp_path / "bad.tsv", text), need).errors
        assert len(errors) == 1 and says in errors[0]
    assert "not found" in V.validate(spark, str(tmp_path / "none.tsv"), need).errors[0]


def test_end_to_end(spark):
    src = fixtures.sources(spark, "/root/testdata/sf0.001")
    refs, targets, truth = src.filter("src = 'S1'"), src.filter("src <> 'S1'"), fixtures.truth(src)
    out = resolve(refs, targets)
    assert out.candidates.count() == out.matched.count() == refs.count()
    cands = {r.s1_id: r.candidates for r in out.candidates.collect()}
    for r in out.matched.collect():
        assert set(r.matched) <= set(cands[r.s1_id]) and len(cands[r.s1_id]) <= 15
    assert evaluate(refs, truth, out.matched).first().macro_f05 > 0.8
    saved = tsv.sink_rows(refs, out.candidates, "candidates", "candidate_entity_ids")
    again = rescore(saved, refs, targets)
    assert again.count() == refs.count()


def test_header_by_position_and_line_numbers(spark, tmp_path):
    need = required(spark, "S1-1", "S1-2")
    again = V.validate(spark, write(tmp_path / "m.tsv", HEAD + "S1-1\t\n" + HEAD + "S1-2\tS2-1\n"), need)
    assert any(V.RULES["unexpected"] in e and "source1_entity_id" in e for e in again.errors)
    assert any(V.RULES["wrong_prefix"] in e and "matched_entity_ids" in e for e in again.errors)
    odd = V.validate(spark, write(tmp_path / "n.tsv", HEAD + "S1-1\t\n\nbroken\nS1-2\t\nalso broken\n"), need)
    (error,) = odd.errors
    assert "2, e.g. line 4: broken, line 6: also broken" in error
    raw = tsv.read_raw(spark, str(tmp_path / "m.tsv"), tsv.TRUTH).collect()
    assert [r.source1_entity_id for r in raw] == ["S1-1", "source1_entity_id", "S1-2"]


def test_line_numbers_over_blocks_and_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(3):
        write(folder / f"part-{k}.tsv", "".join(f"{k} {i} {'x' * (i % 50)}\n" for i in range(1, 4001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = tsv.numbered_lines(spark, str(folder))
        assert rows.rdd.getNumPartitions() > 6
        assert all(int(r.value.split()[1]) == r.line and f"part-{r.value[0]}" in r.file for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_undecodable_files(spark, tmp_path):
    (tmp_path / "m.tsv").write_bytes(HEAD.encode() + b"S1-1\t\xff\xfe\n")
    out = V.validate(spark, str(tmp_path / "m.tsv"), required(spark, "S1-1"))
    assert not out.ok and "UTF-8" in out.errors[0]


def test_ids_from_files(spark, tmp_path):
    head = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    write(tmp_path / "test_source1.tsv", head + "S1-1\ta\tb\tUS\n")
    good = write(tmp_path / "m.tsv", HEAD + "S1-1\tS2-7\n")
    folder = str(tmp_path)
    assert V.validate_files(spark, good, folder).ok
    write(tmp_path / "test_source2.tsv", head + "S2-1\ta\tb\tUS\n")
    out = V.validate_files(spark, good, folder, check_ids=True)
    assert out.ok and any("test_source3.tsv" in w for w in out.warnings)  # not looked up
    write(tmp_path / "test_source3.tsv", head + "S3-1\ta\tb\tUS\n")
    out = V.validate_files(spark, good, folder, check_ids=True)
    assert not out.ok and V.RULES["unknown"] in out.errors[0]
    assert not V.validate_files(spark, good, str(tmp_path / "nowhere")).ok
    missing = V.validate_files(spark, good, folder, candidate_path=str(tmp_path / "c.tsv"))
    assert missing.ok and any("c.tsv" in w for w in missing.warnings)


def test_other_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("S2-1", "A \"quoted\" name", None, "US"), ("S2-2", "", "1 Oak", "India")], tsv.RECORD_SCHEMA)
    tsv.write_tsv(rows, str(tmp_path / "tsv"))
    back = {r.entity_id: r for r in tsv.read_typed(spark, str(tmp_path / "tsv")).collect()}
    assert back["S2-1"].business_name == 'A "quoted" name' and back["S2-1"].business_address is None and back["S2-2"].country == "India"
    tsv.write_json(spark.createDataFrame([(0.5, 3)], "tau double, n int"), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first().asDict() == {"tau": 0.5, "n": 3}


def records(tmp_path, name, rows):
    head = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    return write(tmp_path / name, head + "".join("\t".join(x or "" for x in r) + "\n" for r in rows))


def test_command_line(spark, tmp_path, capsys):
    from millrace import cli

    src = fixtures.sources(spark, "/root/testdata/sf0.001")
    for k in (1, 2, 3):
        rows = src.filter(f"src = 'S{k}'").orderBy("k").select(*tsv.RECORD).collect()
        records(tmp_path, f"test_source{k}.tsv", rows)
    folder, out = str(tmp_path), str(tmp_path / "out")
    pairs = fixtures.truth(src).groupBy("s1_id").agg(F.concat_ws(",", F.collect_list("t_id")).alias("ids")).collect()
    write(tmp_path / "truth.tsv", "source1_entity_id\tmatched_entity_ids\n" + "".join(f"{r.s1_id}\t{r.ids}\n" for r in pairs))
    assert cli.main(["resolve", "--test-dir", folder, "--output-dir", out]) == 0
    result = [f"{out}/matching_results.tsv", f"{out}/candidate_pairs.tsv"]
    assert cli.main(["validate", "--matching", result[0], "--candidate", result[1], "--test-dir", folder, "--check-ids"]) == 0
    ids = [r.source1_entity_id for r in tsv.read_raw(spark, result[0], tsv.TRUTH).collect()]
    assert ids == [r.entity_id for r in tsv.read_typed(spark, f"{folder}/test_source1.tsv").collect()]  # in the order of the references
    again = f"{out}/again.tsv"
    assert cli.main(["rescore", "--test-dir", folder, "--candidate-path", result[1], "--output-matching", again]) == 0
    assert cli.main(["validate", "--matching", again, "--test-dir", folder]) == 0
    capsys.readouterr()
    assert cli.main(["benchmark-blocking", "--source1", f"{folder}/test_source1.tsv", "--source2", f"{folder}/test_source2.tsv", "--source3", f"{folder}/test_source3.tsv", "--truth", f"{folder}/truth.tsv", "--rows", "20"]) == 0
    assert "recall" in capsys.readouterr().out
    assert cli.main(["validate", "--matching", f"{out}/none.tsv", "--test-dir", folder]) == 1
    assert "FAIL" in capsys.readouterr().out
