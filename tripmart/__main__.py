"""Command line: one run, the whole backlog, or given months again.

    python -m tripmart --source S --root R --zones Z [--as-of 2024-05-01] [--versioned]
        [--backlog | --dataset yellow --period 2024-02 | --dataset yellow --year 2024 --month 2]
"""

from __future__ import annotations

import argparse
from datetime import date

from tripmart.plans.run import Lake, run
from tripmart.schema import DATASETS
from tripmart.session import cluster_session


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripmart", description=__doc__.splitlines()[0])
    for name in ("source", "root", "zones"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    parser.add_argument("--backlog", action="store_true")
    parser.add_argument("--versioned", action="store_true")
    parser.add_argument("--dataset", choices=DATASETS)
    parser.add_argument("--period")
    parser.add_argument("--year", type=int)
    parser.add_argument("--month", type=int)
    options = parser.parse_args(given)
    if options.period is None and options.year and options.month:
        options.period = f"{options.year:04d}-{options.month:02d}"
    if options.period and options.backlog:
        parser.error("--backlog and a period exclude each other")
    return options


def main(given: list[str] | None = None) -> list[tuple[str, str]]:
    options = arguments(given)
    datasets = [options.dataset] if options.dataset else list(DATASETS)
    lake = Lake(source=options.source, root=options.root, zones_csv=options.zones, versioned=options.versioned)
    return run(
        cluster_session(),
        lake,
        options.as_of,
        datasets,
        options.backlog,
        [(d, options.period) for d in datasets] if options.period else None,
    )


if __name__ == "__main__":
    for dataset, period in main():
        print(dataset, period)
