"""python -m voxframe run CONFIG [--force] [--from STAGE] | pick SEG RAW OUT | show CONFIG"""

from __future__ import annotations

import argparse
import json


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="voxframe", description="Particle picking, classification and identification on Spark")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="all stages of a configuration that aren't finished")
    run.add_argument("config")
    run.add_argument("--force", action="store_true", help="run finished stages again")
    run.add_argument("--from", dest="start", help="run again from this stage on")
    one = commands.add_parser("pick", help="particles of a folder of segmentations")
    for name in ("segmentations", "tomograms", "out"):
        one.add_argument(name)
    one.add_argument("--voxel", type=float)
    one.add_argument("--rule", default="union", choices=["union", "intersection"])
    show = commands.add_parser("show", help="a configuration as it is understood")
    show.add_argument("config")
    args = parser.parse_args(argv)
    from pyspark.sql import SparkSession

    from .plans.run import Run, RunSettings

    if args.command == "show":
        print(json.dumps(vars(RunSettings.from_file(args.config)), indent=2, default=vars))
        return
    spark = SparkSession.builder.appName("voxframe").getOrCreate()
    if args.command == "run":
        Run(spark, RunSettings.from_file(args.config)).go(args.force, args.start)
    else:
        Run(spark, RunSettings(args.segmentations, args.tomograms, args.out, args.voxel, rule=args.rule, stop_after="pick")).go()


if __name__ == "__main__":
    main()
