"""python -m quern.jobs NAME [arguments]: a job's parameters are its options (--max-partitions 100); lists take several values; -P name=value adds a property."""

from __future__ import annotations

import argparse
import inspect
import json
import os

from pyspark.sql import SparkSession

from quern import jobs

NAMES = {
    "extract": jobs.extract, "dedup": jobs.dedup, "merge-stats": jobs.merge_stats, "filter-stats": jobs.filter_stats, "perplexity": jobs.perplexities, "repackage": jobs.repackage, "clean": jobs.clean,
    "documents": jobs.documents, "minhash": jobs.minhash_dedup, "removed-sizes": jobs.removed_sizes,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quern.jobs")
    found = top.add_subparsers(dest="job", required=True)
    for name, job in NAMES.items():
        one = found.add_parser(name, help=(job.__doc__ or "").split("\n")[0], description=job.__doc__)
        one.add_argument("--config", help="JSON with options; those of the command line come first")
        for key, p in list(inspect.signature(job).parameters.items())[1:]:
            kind, option = str(p.annotation), f"--{key.replace('_', '-')}"
            if key == "properties":
                one.add_argument("-P", dest=key, action="append", metavar="NAME=VALUE")
            elif "bool" in kind:
                one.add_argument(option, action=argparse.BooleanOptionalAction, default=None)
            elif "list" in kind:
                one.add_argument(option, nargs="+")
            else:
                one.add_argument(option, type=int if "int" in kind else float if "float" in kind else str)
    return top


def options(args: list[str] | None = None) -> tuple[str, dict]:
    """The job's name and its arguments: of the command line, else of the configuration, else of the job."""
    given = {k: v for k, v in vars(parser().parse_args(args)).items() if v is not None}
    name, config = given.pop("job"), given.pop("config", None)
    if "properties" in given:
        given["properties"] = dict(p.split("=", 1) for p in given["properties"])
    if config:
        with open(config, encoding="utf-8") as f:
            given = json.load(f) | given
    wanted = list(inspect.signature(NAMES[name]).parameters.values())[1:]
    if missing := [p.name for p in wanted if p.default is p.empty and p.name not in given]:
        raise SystemExit(f"{name} needs {', '.join('--' + m.replace('_', '-') for m in missing)}")
    if unknown := set(given) - {p.name for p in wanted}:
        raise SystemExit(f"{name} has no option {', '.join(sorted(unknown))}")
    return name, given


def main(args: list[str] | None = None) -> None:
    name, given = options(args)
    builder = SparkSession.builder.appName(f"quern {name}")
    if "SPARK_MASTER" in os.environ:
        builder = builder.master(os.environ["SPARK_MASTER"])
    told = NAMES[name](builder.getOrCreate(), **given)
    if told is not None:
        told.show(100, truncate=False)


if __name__ == "__main__":
    main()
