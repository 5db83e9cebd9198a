"""Command line: ``spark-submit riskloom/jobs.py --root URL --stage preprocess --stage features ...``.

The stages ``score``, ``monitor`` and ``watch`` are streams: they run until stopped (or ``--once``) and go on where they
left off when started again.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from riskloom.operators.model import ForestSettings
from riskloom.plans import stages
from riskloom.session import build_session

STAGES = ["ingest", "load", "preprocess", "features", "training", "drift", "score", "monitor", "watch"]


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run stages; each reads and writes tables under --root.")
    parser.add_argument("--root", required=True, help="folder on shared storage")
    parser.add_argument("--stage", action="append", choices=STAGES, required=True, help="may be given several times")
    parser.add_argument("--csv", help="raw CSV for the ingest stage, or the next load for the load stage")
    parser.add_argument("--live", help="folder of live JSON records for the drift and watch stages")
    parser.add_argument("--requests", help="folder of JSON requests, one a line, for the score stage")
    parser.add_argument("--log", help="folder of the prediction log (Parquet) for the monitor stage")
    parser.add_argument("--once", action="store_true", help="streams: stop when the data at hand are done")
    parser.add_argument("--master", help="only for trying out; spark-submit sets it otherwise")
    how = stages.Settings()
    parser.add_argument("--run-name", default=how.run_name)
    parser.add_argument("--seed", type=int, default=how.seed)
    parser.add_argument("--test-fraction", type=float, default=how.test_fraction)
    parser.add_argument("--folds", type=int, default=how.folds)
    parser.add_argument("--trees", type=int, default=how.forest.trees)
    parser.add_argument("--depth", type=int, default=how.forest.depth)
    args = parser.parse_args(argv)
    for stage, name in (("ingest", "csv"), ("load", "csv"), ("drift", "live"), ("score", "requests"), ("monitor", "log"), ("watch", "live")):
        if stage in args.stage and not getattr(args, name):
            parser.error(f"--stage {stage} needs --{name}")
    spark = build_session("address-risk", args.master)
    at = stages.Layout(args.root)
    how = stages.Settings(
        seed=args.seed, test_fraction=args.test_fraction, folds=args.folds, run_name=args.run_name,
        forest=ForestSettings(args.trees, args.depth, args.seed),
    )
    run = {
        "ingest": lambda: stages.ingest(spark, at, args.csv),
        "load": lambda: stages.load_stage(spark, at, args.csv, how),
        "preprocess": lambda: stages.preprocess_stage(spark, at, how),
        "features": lambda: stages.feature_stage(spark, at),
        "training": lambda: stages.training_stage(spark, at, how).summary.show(truncate=False),
        "drift": lambda: stages.drift_stage(spark, at, args.live, how).show(truncate=False),
        "score": lambda: stages.score_stage(spark, at, args.requests, how, once=args.once),
        "monitor": lambda: stages.monitor_stage(spark, at, args.log, once=args.once),
        "watch": lambda: stages.watch_stage(spark, at, args.live, how, once=args.once),
    }
    for stage in STAGES:
        if stage in args.stage:
            run[stage]()


if __name__ == "__main__":
    main()
