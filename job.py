"""Spark-submit entry: drain the chosen stages once.

    spark-submit job.py --stages ingest transform --env dev --space feature \
        --base-path s3a://bucket/trades --source-option subscribe=trades ...

``--config`` names a JSON file with any fields of ``PipelineConfig``; options given here win over
it. Secrets belong there, or in a variable named by ``--source-option-env NAME=VARIABLE`` (likewise
``raw`` and ``topic``), since arguments can be read in every process list. With raw options the
chain begins with ``land``, which routes raw messages into the topic.
"""

from __future__ import annotations

import argparse
import json
import os
from dataclasses import fields
from pathlib import Path

from pyspark.sql import SparkSession

from ticksmith import STAGES, PipelineConfig, run
from ticksmith.config import ENVIRONMENTS, SPACES
from ticksmith.plans import LAND, chain


def settings(arguments: list[str] | None = None) -> tuple[PipelineConfig, list[str]]:
    """The configuration and stages that the arguments ask for."""
    parser = argparse.ArgumentParser()
    parser.add_argument("--stages", nargs="+", choices=[LAND, *STAGES])
    parser.add_argument("--config", metavar="FILE")
    parser.add_argument("--env", choices=ENVIRONMENTS)
    parser.add_argument("--space", choices=SPACES)
    parser.add_argument("--base-path")
    parser.add_argument("--format", dest="fmt")
    parser.add_argument("--catalog")
    for name in ("source", "raw"):
        parser.add_argument(f"--{name}-format")
    for name in ("source", "raw", "topic"):
        parser.add_argument(f"--{name}-option", action="append", default=[], metavar="NAME=VALUE")
        parser.add_argument(f"--{name}-option-env", action="append", default=[], metavar="NAME=VARIABLE")
    parser.add_argument("--symbols", nargs="+")
    parser.add_argument("--arrival", nargs="+")
    for name in ("precision", "clean-mode", "dedup-within", "candle-width", "watermark", "order", "clock", "late"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--state-provider")
    for name in ("max-files-per-trigger", "state-partitions", "timeout-seconds"):
        parser.add_argument(f"--{name}", type=int)
    for name in ("partition-by-date", "collapse-copies", "count-state-rows", "count-content"):
        parser.add_argument(f"--{name}", action=argparse.BooleanOptionalAction)
    args = parser.parse_args(arguments)

    chosen = json.loads(Path(args.config).read_text()) if args.config else {}
    known = {f.name for f in fields(PipelineConfig)}
    if unknown := sorted(set(chosen) - known):
        parser.error(f"unknown settings in {args.config}: {', '.join(unknown)}")
    given = {name: value for name, value in vars(args).items() if value is not None}
    chosen |= {name: value for name, value in given.items() if name in known}
    for name in ("symbols", "arrival"):
        chosen[name] = tuple(chosen.get(name, ()))
    for kind in ("source", "raw", "topic"):
        options = dict(chosen.get(f"{kind}_options", {}))
        options |= dict(option.split("=", 1) for option in getattr(args, f"{kind}_option"))
        for option in getattr(args, f"{kind}_option_env"):
            name, variable = option.split("=", 1)
            options[name] = os.environ[variable]
        chosen[f"{kind}_options"] = options
    for name in ("env", "space", "base_path"):
        if name not in chosen:
            parser.error(f"{name} is needed, as an option or in the config file")
    cfg = PipelineConfig(**chosen)
    return cfg, args.stages or chain(cfg)


def main() -> None:
    cfg, stages = settings()
    run(SparkSession.builder.getOrCreate(), cfg, stages)


if __name__ == "__main__":
    main()
