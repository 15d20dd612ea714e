"""``python -m wellspring``: start a run from a configuration, or take one up again at a stage."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from typing import Any

from . import run as runs
from .session import session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wellspring")
    p.add_argument("--config", help="configuration of a new run (JSON, or YAML where a parser is installed)")
    p.add_argument("--resume", metavar="OUT_DIR", help="folder of a run to take up again")
    p.add_argument("--stage", choices=runs.STAGES, default=runs.FILTERING, help="first stage; all but the first need --resume")
    p.add_argument("--last", choices=runs.STAGES, default=runs.SUMMARISING)
    p.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", help="a setting over the configuration's")
    kind = p.add_mutually_exclusive_group()
    kind.add_argument("--manual", help="ids of manual barcode sets")
    kind.add_argument("--plate", help="numbers of plates")
    kind.add_argument("--expected", help="a table of wells and their barcodes")
    p.add_argument("--master", default="local[8]")
    p.add_argument("--isoform-index-only", action="store_true", help="write the transcript indices and end")
    p.add_argument("--isoform-index", nargs=2, metavar=("EXONS", "JUNCTIONS"))
    p.add_argument("--isoform-matrix", action="store_true")
    p.add_argument("--skip-isoforms", action="store_true")
    return p


def checked(args: Sequence[str] | None = None) -> argparse.Namespace:
    """Arguments that fit together; others end the program with a message."""
    p = parser()
    a = p.parse_args(args)
    if bool(a.config) == bool(a.resume):
        p.error("either --config or --resume is needed")
    if a.stage != runs.FILTERING and not a.resume:
        p.error(f"--stage {a.stage} needs --resume")
    if runs.STAGES.index(a.last) < runs.STAGES.index(a.stage):
        p.error("--last comes before --stage")
    if a.isoform_index_only and (a.isoform_index or a.isoform_matrix or a.skip_isoforms):
        p.error("--isoform-index-only stands alone")
    if a.isoform_matrix and a.skip_isoforms:
        p.error("--isoform-matrix needs isoforms")
    if bad := [s for s in a.set if "=" not in s]:
        p.error(f"--set takes NAME=VALUE: {bad[0]}")
    return a


def settings(a: argparse.Namespace, config: dict[str, Any]) -> dict[str, Any]:
    import json

    out = dict(config)
    for name, _, value in (s.partition("=") for s in a.set):
        try:
            out[name] = json.loads(value)
        except ValueError:
            out[name] = value
    for name in ("manual", "plate", "expected"):
        if value := getattr(a, name):
            out[name] = value if name == "expected" else [x.strip() for x in value.split(",") if x.strip()]
    return out


def main(args: Sequence[str] | None = None) -> None:
    a = checked(args)
    spark = session(a.master)
    if a.resume:
        config = runs.load_config(spark, a.resume)
    else:
        config = runs.parse_config("\n".join(r.value for r in spark.read.text(a.config, wholetext=True).collect()))
    run = runs.Run(spark, settings(a, config))
    for left in runs.start(run, a.stage, a.last):
        print(run.at(left))
    if a.last == runs.SUMMARISING:
        runs.deliver(run)


if __name__ == "__main__":
    main()
