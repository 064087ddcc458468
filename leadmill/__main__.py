"""Command line: import seeds, screen, cluster, export.

    python -m leadmill --action importsmiles --database DIR --smiles seeds.smi --providers module:factory
    python -m leadmill --action screen --database DIR --mode greedy --providers module:factory --space DATA
    python -m leadmill --action cluster --database DIR
    python -m leadmill --action exportcsv --database DIR --cutoff -10 --export_file OUT

`factory(spark, space)` returns an object with the campaign's `search`, `prepare` and `score`.
"""

from __future__ import annotations

import argparse
import importlib
from dataclasses import replace

from pyspark.sql import SparkSession

from .jobs import screening
from .schema import Settings
from .sources import readers
from .store import Campaign

NEEDS = {"importsmiles": ("smiles", "providers"), "screen": ("providers",), "cluster": (), "exportcsv": ("export_file",)}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="leadmill", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--action", required=True, choices=list(NEEDS))
    p.add_argument("--database", required=True, help="folder of the campaign")
    p.add_argument("--smiles", help="seeds, lines `SMILES title`")
    p.add_argument("--dock_params", help="parameter file to keep with the campaign")
    p.add_argument("--dock_grid", help="grid file to keep with the campaign")
    p.add_argument("--mode", choices=["greedy", "clustering"], default="greedy", help="how compounds are picked")
    p.add_argument("--providers", help="module:factory of search, prepare and score")
    p.add_argument("--space", help="what the search provider searches")
    p.add_argument("--simsearch_queries", type=int, default=Settings.queries_per_cycle)
    p.add_argument("--dock_mols", type=int, default=Settings.docked_per_round)
    p.add_argument("--simsearch_cpus", type=int, help="accepted and not used: the session decides")
    p.add_argument("--dock_cpus", type=int, help="accepted and not used: the session decides")
    p.add_argument("--cutoff", type=float, default=Settings.export_cutoff)
    p.add_argument("--export_file", help="folder of the exported CSV")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = parser()
    args = p.parse_args(argv)
    lacking = [f"--{name}" for name in NEEDS[args.action] if getattr(args, name) is None]
    if lacking:
        p.error(f"--action {args.action} needs {', '.join(lacking)}")
    spark = spark or SparkSession.builder.appName("leadmill").getOrCreate()
    campaign = Campaign(spark, args.database)
    settings = replace(Settings(), acquisition=args.mode, queries_per_cycle=args.simsearch_queries, docked_per_round=args.dock_mols, export_cutoff=args.cutoff)
    if args.action != "importsmiles" and campaign.read("compounds") is None:
        p.error(f"no campaign in {args.database}")
    space = None
    if args.providers:
        module, _, name = args.providers.partition(":")
        space = getattr(importlib.import_module(module), name or "factory")(spark, args.space)
    if args.action == "importsmiles":
        with campaign.step():
            screening.import_seeds(campaign, readers.undocked_seeds(spark, args.smiles), space.prepare, docked=False, settings=settings)
            for name, path in (("docking_param", args.dock_params), ("docking_grid", args.dock_grid)):
                if path:
                    campaign.write(name, readers.blob(spark, path))
    elif args.action == "screen":
        if campaign.read("compounds").filter("dock_score is not null").isEmpty():
            screening.dock(campaign, space.score, settings, seeds=True)
        screening.screening_round(campaign, space.search, space.prepare, space.score, settings)
    elif args.action == "cluster":
        screening.recluster(campaign, settings)
    else:
        screening.export_results(campaign, args.export_file, settings)


if __name__ == "__main__":
    main()
