"""The command line: ``python -m millrace.cli resolve | rescore | validate | benchmark-blocking``.

Inputs are the three source files of a test folder; outputs are folders of
tab-separated parts, as Spark writes them.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.decide import PIPELINE, RESCORE, Thresholds
from millrace.operators.model import BoostedTrees, Scorer
from millrace.operators.validate import validate_files
from millrace.plans import resolve as R
from millrace.sources.scratch import exists
from millrace.sources.tsv import TRUTH, assert_unique, parse_truth, read_raw, read_typed, sink_rows, truth_pairs, write_lists


def _references(spark: SparkSession, path: str) -> DataFrame:
    """Records with ``position``, their place in the file."""
    return assert_unique(read_typed(spark, path)).withColumn("position", F.monotonically_increasing_id())


def _targets(spark: SparkSession, folder: str) -> DataFrame:
    return read_raw(spark, f"{folder}/test_source2.tsv").unionByName(read_raw(spark, f"{folder}/test_source3.tsv"))


def _scorer(spark: SparkSession, args: argparse.Namespace) -> Scorer | None:
    """The named model (or its namesake in the working folder); without a name the fixed scorecard."""
    if not args.model_path:
        return None
    return BoostedTrees.load(spark, args.model_path, args.model_path.rstrip("/").rsplit("/", 1)[-1])


def _thresholds(scorer: Scorer | None, args: argparse.Namespace, default: Thresholds) -> Thresholds:
    """As given, else those saved with the model, else the plan's."""
    own = scorer.thresholds if isinstance(scorer, BoostedTrees) else default
    return Thresholds(own.tau if args.threshold is None else args.threshold, own.sing if args.singleton_threshold is None else args.singleton_threshold)


def resolve(spark: SparkSession, args: argparse.Namespace) -> int:
    references, scorer = _references(spark, f"{args.test_dir}/test_source1.tsv"), _scorer(spark, args)
    out = R.resolve(references, _targets(spark, args.test_dir), scorer, _thresholds(scorer, args, PIPELINE))
    for lists, column, name, cell in ((out.matched, "matched", "matching_results.tsv", "matched_entity_ids"), (out.candidates, "candidates", "candidate_pairs.tsv", "candidate_entity_ids")):
        write_lists(sink_rows(references, lists, column, cell, position="position"), f"{args.output_dir}/{name}")
    out.release()
    return 0


def rescore(spark: SparkSession, args: argparse.Namespace) -> int:
    references, scorer = _references(spark, f"{args.test_dir}/test_source1.tsv"), _scorer(spark, args)
    saved = read_raw(spark, args.candidate_path, ["source1_entity_id", "candidate_entity_ids"])
    found = R.rescore(saved, references, _targets(spark, args.test_dir), scorer, _thresholds(scorer, args, RESCORE))
    write_lists(sink_rows(references, found, "matched", "matched_entity_ids", position="position"), args.output_matching)
    return 0


def validate(spark: SparkSession, args: argparse.Namespace) -> int:
    out = validate_files(spark, args.matching, args.test_dir, args.candidate, args.check_ids)
    print(out.text())
    return 0 if out.ok else 1


def benchmark_blocking(spark: SparkSession, args: argparse.Namespace) -> int:
    truth = truth_pairs(parse_truth(read_raw(spark, args.truth, TRUTH)))
    targets = read_raw(spark, args.source2).unionByName(read_raw(spark, args.source3))
    row = R.benchmark_blocking(read_typed(spark, args.source1), targets, truth, args.rows).first()
    print("\n".join(f"{k}: {v}" for k, v in row.asDict().items()))
    return 0


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, run, *options: tuple) -> None:  # noqa: ANN001
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        for flag, kind, default in options:
            sub.add_argument(flag, **({"action": "store_true"} if kind is bool else {"type": kind, "default": default}))

    model = [("--model-path", str, None), ("--threshold", float, None), ("--singleton-threshold", float, None)]
    add("resolve", resolve, ("--test-dir", str, "dataset/test"), ("--output-dir", str, "output"), *model)
    add("rescore", rescore, ("--test-dir", str, "dataset/test"), ("--candidate-path", str, "output/candidate_pairs.tsv"), ("--output-matching", str, "output/matching_results.tsv"), *model)
    add("validate", validate, ("--matching", str, "output/matching_results.tsv"), ("--candidate", str, None), ("--test-dir", str, "dataset/test"), ("--check-ids", bool, False))
    sources = [("--source1", str, "val_source1.tsv"), ("--source2", str, "train_source2.tsv"), ("--source3", str, "train_source3.tsv")]
    add("benchmark-blocking", benchmark_blocking, *sources, ("--truth", str, "val_ground_truth.tsv"), ("--rows", int, 200_000))
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName("millrace").getOrCreate()
    if args.command == "validate" and args.candidate is None and exists(spark, "output/candidate_pairs.tsv"):
        args.candidate = "output/candidate_pairs.tsv"
    return args.run(spark, args)


if __name__ == "__main__":
    sys.exit(main())
